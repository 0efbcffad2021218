"""Match documents to typed participant rows under a configurable field map."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchforge import schema
from matchforge.functions.numeric import epoch_ms_to_timestamp, text_to_bigint
from matchforge.session import PLACE, TASK, at_places, stage, stage_with_places

# Characters JSON allows around a document.
BLANKS = " \t\r\n"
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}
# The list that a text is put into to be parsed.
_ALONE = "__alone"


def required_paths(field_map: Mapping[str, str], types: Mapping[str, str]) -> tuple[dict, dict]:
    """Columns read at match level and, as a tree, the participant fields they need.

    A tree leaf is the SQL type of the columns read from it.
    """
    match_level = {name: "string" for name in schema.MATCH_LEVEL_PATHS.values()}
    tree: dict = {"puuid": "string"}
    for column, path in field_map.items():
        if path == schema.MATCH_ID_PATH:
            continue
        if path in schema.MATCH_LEVEL_PATHS:
            match_level[schema.MATCH_LEVEL_PATHS[path]] = column_type(column, types)
            continue
        node = tree
        *parents, leaf = path.split(".")
        for name in parents:
            node = node.setdefault(name, {})
            if not isinstance(node, dict):
                raise ValueError(f"field path {path!r} runs through another selected field")
        known = node.setdefault(leaf, column_type(column, types))
        if isinstance(known, dict):
            raise ValueError(f"field path {path!r} is also a parent of another field")
        if known != column_type(column, types):
            node[leaf] = "string"
    return match_level, tree


def column_type(column: str, types: Mapping[str, str]) -> str:
    """Type a fact column is parsed as; epoch milliseconds become timestamps later."""
    if column in types:
        return types[column]
    if column in schema.INTEGER_COLUMNS or column in schema.EPOCH_MS_COLUMNS:
        return "bigint"
    return "boolean" if column in schema.BOOLEAN_COLUMNS else "string"


def struct_type(tree: Mapping, *, as_text: bool) -> str:
    fields = [
        f"`{name}`: " + (
            struct_type(node, as_text=as_text) if isinstance(node, dict) else "string" if as_text else node
        )
        for name, node in tree.items()
    ]
    return f"STRUCT<{', '.join(fields)}>"


def typed_struct(value: Column, tree: Mapping) -> Column:
    """Cast the text leaves of ``value`` to the types in ``tree``; unusable ones become null."""
    fields = []
    for name, node in tree.items():
        if isinstance(node, dict):
            field = F.when(value[name].isNotNull(), typed_struct(value[name], node))
        elif node == "bigint":
            field = text_to_bigint(value[name])
        else:
            field = value[name].try_cast(node)
        fields.append(field.alias(name))
    return F.struct(*fields)


def looks_like_object() -> Column:
    """Whether a record begins and ends like a JSON object; a parser's failure costs far more than this."""
    text = F.col("_raw_json")
    starts = text.startswith("{") | F.ltrim(text, F.lit(BLANKS)).startswith("{")
    return starts & (text.endswith("}") | F.rtrim(text, F.lit(BLANKS)).endswith("}"))


def is_json_object() -> Column:
    """Whether a record is one JSON object and nothing else.

    The parser stops behind the first value, so the text is put between brackets:
    more text breaks the list, and a second object makes it longer. Repeated keys and
    NaN are accepted, single quotes are not.
    """
    listed = F.from_json(F.concat(F.lit("["), "_raw_json", F.lit("]")), "ARRAY<STRUCT<_none: STRING>>", STRICT)
    return F.coalesce(looks_like_object() & (F.size(listed) == 1), F.lit(False))


def parse_documents(
    raw: DataFrame, field_map: Mapping[str, str], types: Mapping[str, str], *carry: str
) -> DataFrame:
    """Match-level fields as struct ``info`` and participants as typed array, per document.

    Only the selected paths are parsed, with the types the columns need. The parse is the
    strict test as well: the text is the only element of a list inside an object of our own,
    so what follows it breaks that object or makes the list longer. A document that does not
    pass, or in which some value has another JSON type (a number given as text, say), is
    tested by itself, parsed again with all leaves as text and cast value by value, so
    one odd value does not cost the others. What is no JSON object has no participants.
    """
    match_level, tree = required_paths(field_map, types)

    def fields(*, as_text: bool) -> str:
        info = struct_type(match_level, as_text=as_text)[len("STRUCT<"):-1]
        return f"info: STRUCT<{info}, participants: ARRAY<{struct_type(tree, as_text=as_text)}>>"

    alone = F.concat(F.lit(f'{{"{_ALONE}": ['), "_raw_json", F.lit("]}"))
    parsed = F.from_json(
        alone, f"{_ALONE} ARRAY<STRUCT<{fields(as_text=False)}>>, _odd STRING",
        {**STRICT, "columnNameOfCorruptRecord": "_odd"})
    as_text = F.from_json("_raw_json", f"STRUCT<{fields(as_text=True)}>")
    # a text with the name of our list could close that list and open another one
    odd = F.col("whole._odd").isNotNull() | F.col("_raw_json").contains(f'"{_ALONE}"')

    def retyped(participant: Column) -> Column:
        return F.when(participant.isNotNull(), typed_struct(participant, tree))

    # Each document is a column of its own before it is used, so it is parsed once.
    return (
        raw.select("match_id", *carry, "_raw_json", F.when(looks_like_object(), parsed).alias("whole"))
        .select(
            "match_id", *carry, odd.alias("odd"),
            F.when(F.size(f"whole.{_ALONE}") == 1, F.get(f"whole.{_ALONE}", F.lit(0))).alias("doc"),
            F.when(odd, F.when(is_json_object(), as_text["info"])).alias("text"))
        .select(
            "match_id",
            *carry,
            F.when(F.col("odd"), typed_struct(F.col("text"), match_level)).otherwise(
                F.struct(*[F.col(f"doc.info.{name}") for name in match_level])
            ).alias("info"),
            F.when(F.col("odd"), F.transform("text.participants", retyped))
            .otherwise(F.col("doc.info.participants")).alias("participants"),
        )
    )


def resolve(column: str, path: str, types: Mapping[str, str]) -> Column:
    """Value of one field path; anything missing on the way is null."""
    if path == schema.MATCH_ID_PATH:
        value = F.col("match_id")
    elif path in schema.MATCH_LEVEL_PATHS:
        value = F.col("info")[schema.MATCH_LEVEL_PATHS[path]]
    else:
        value = F.col("participant")
        for name in path.split("."):
            value = value[name]
    if column in schema.EPOCH_MS_COLUMNS:
        return epoch_ms_to_timestamp(value)
    if column == "team_position":
        return normalize_position(value)
    return value.try_cast(column_type(column, types))


def normalize_position(position: Column) -> Column:
    """API position names to the names used here; others and null unchanged."""
    renamed = F.lit(None).cast("string")
    for api_name, name in schema.POSITION_NAMES.items():
        renamed = F.when(position == api_name, F.lit(name)).otherwise(renamed)
    return F.coalesce(renamed, position)


def normalize_position_columns(df: DataFrame) -> DataFrame:
    """Re-apply the position names to whichever position columns ``df`` has."""
    present = [c for c in ("team_position", "main_position") if c in df.columns]
    return df.withColumns({c: normalize_position(F.col(c)) for c in present}) if present else df


def flatten_matches(
    raw: DataFrame,
    field_map: Mapping[str, str] = schema.DEFAULT_FIELD_MAP,
    *,
    types: Mapping[str, str] = MappingProxyType({}),
    deduplicate: bool = True,
    first_by: Sequence[str] = (),
    keep: Sequence[str] = (),
    parse: Callable[..., DataFrame] = parse_documents,
) -> DataFrame:
    """One typed row per participant of each match document.

    ``raw`` has ``match_id`` and ``_raw_json``. ``types`` names the SQL types of
    columns the schema does not know; others of those are text. Undecodable documents, documents
    that are not objects and documents without participants give no rows. With
    ``deduplicate`` the first row per (match, player) is kept, first meaning
    the order of ``first_by`` and then the place in the document; with such an order that is
    ``flatten_first``, which stages the rows. Without ``deduplicate``, ``keep`` names
    columns of ``raw``, which come as ``__by_`` columns, or keys to carry along. ``parse`` takes
    the documents apart; another one reads them from another form than text.
    """
    if not field_map:
        raise ValueError("the field map selects no columns")
    if deduplicate and first_by:
        return flatten_first(raw, field_map, types=types, first_by=first_by, parse=parse)
    own = ("__match", "__player", "__place")
    carried = list(dict.fromkeys([*first_by, *(c for c in keep if c not in own)]))
    # what the match says is worked out once for all of its participants
    of_match = {name: path for name, path in field_map.items() if path in schema.MATCH_LEVEL_PATHS}
    # a filter on what the match says stops above this id, always true; below it, each mention would parse the text again
    parsed_once = F.when(F.monotonically_increasing_id() >= 0, F.col("participants")).alias("participants")
    rows = (
        parse(raw, field_map, types, *carried)
        .select("match_id", *carried, *[resolve(name, path, types).alias(f"__of_{name}") for name, path in of_match.items()], parsed_once)
        .select(
            "match_id", *carried, *[f"__of_{name}" for name in of_match],
            F.posexplode_outer("participants").alias("__place", "participant"),
        )
        .filter(F.col("participant").isNotNull())
        .select(
            *[(F.col(f"`__of_{name}`") if name in of_match else resolve(name, path, types)).alias(name)
              for name, path in field_map.items()],
            F.col("match_id").alias("__match"),
            F.col("participant.puuid").alias("__player"),
            *[F.col(name).alias(f"__by_{name}") for name in carried],
            "__place",
        )
    )
    if deduplicate:
        rows = keep_first(rows, ["__match", "__player"], ["__place"])
    return rows.select(*field_map, *[c if c in own else f"__by_{c}" for c in keep])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key under ``order``; a null key is a key like any other.

    Spark cuts each input partition to its first row per key before the
    shuffle, so a key with very many copies does not pile up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__row", F.row_number().over(window)).filter(F.col("__row") == 1).drop("__row")
    )


def corrupt_matches(raw: DataFrame) -> DataFrame:
    """Ids of the documents that are skipped because they are not JSON objects."""
    return raw.filter(~is_json_object()).select("match_id")


def flatten_first(
    raw: DataFrame,
    field_map: Mapping[str, str] = schema.DEFAULT_FIELD_MAP,
    *,
    types: Mapping[str, str] = MappingProxyType({}),
    first_by: Sequence[str],
    known: DataFrame | None = None,
    parse: Callable[..., DataFrame] = parse_documents,
) -> DataFrame:
    """What ``flatten_matches`` gives, deduplicated without shuffling whole rows.

    Without the rows of the (match, player) pairs in ``known``, if given: two columns in that order, each
    pair once.

    All rows are flattened once, into a table staged with places. Rows whose keys have the same
    hash are found by one grouping of hashes and places, their keys and order are read at those places, and
    settle which of them are later copies. Those are left out by their places.
    """
    # a key that the fact holds as it is, is not kept a second time
    texts = {path: name for name, path in field_map.items() if column_type(name, types) == "string" and name != "team_position"}
    keys = texts.get(schema.MATCH_ID_PATH, "__match"), texts.get("puuid", "__player")
    order = [*[f"__by_{name}" for name in first_by], "__place"]
    keep = [*[k for k in keys if k not in field_map], "__place", *first_by]
    flat = flatten_matches(raw, field_map, types=types, deduplicate=False, keep=keep, parse=parse)
    rows = stage_with_places(flat, "flat_rows")

    def of_keys(some: DataFrame, others: DataFrame, *columns: str) -> DataFrame:
        others = others.select(*[F.col(k).alias(f"__same_{k}") for k in keys], *columns)
        return some.join(others, [some[k].eqNullSafe(others[f"__same_{k}"]) for k in keys])

    hashed = rows.select(F.xxhash64(*keys).alias("__hash"), PLACE)
    alike = stage(hashed.groupBy("__hash").agg(
        F.count(F.lit(1)).alias("n"), F.min(PLACE).alias("least"), F.max(PLACE).alias("most")).filter("n > 1"), "alike")
    places = alike.select(F.explode(F.array("least", "most")).alias(PLACE))
    between = alike.filter("n > 2").select("__hash")
    if not between.isEmpty():
        places = places.unionByName(hashed.join(between, "__hash", "left_semi").select(PLACE))
    copies = stage(at_places(rows.select(*keys, *order, TASK, PLACE), places), "copies")
    first = copies.groupBy(*keys).agg(F.min(F.struct(*order, PLACE)).alias("__first"))
    left_out = of_keys(copies, first, "__first").filter(F.col(PLACE) != F.col(f"__first.{PLACE}")).select(PLACE)
    if known is not None:
        left_out = left_out.unionByName(of_keys(rows.select(*keys, PLACE), known.toDF(*keys)).select(PLACE))
    return at_places(rows, left_out, inside=False).select(*field_map)
