"""Match documents parsed once and kept as VARIANT, from which any field map can be read.

Landing a document costs one parse; a later field map, or another one, reads paths of the
stored values and no JSON text. What the VARIANT parser refuses but the flattening accepts
(repeated keys, NaN) is kept as text beside it, so both ways give the same rows; what is no
JSON object has neither and gives none. Numbers read as text come in their shortest form.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge.operators.flatten import (
    is_json_object, looks_like_object, parse_documents, required_paths, struct_type, typed_struct,
)


def parsed(raw: DataFrame, *carry: str) -> DataFrame:
    """Raw records as ``match_id``, ``carry``, ``document`` (VARIANT) and ``odd`` (text of the few others)."""
    # the parser stops behind the first value; between brackets, more text breaks the list or makes it longer
    listed = F.when(looks_like_object(), F.try_parse_json(F.concat(F.lit("["), "_raw_json", F.lit("]"))))
    rows = raw.select("match_id", *carry, "_raw_json", listed.alias("listed"))
    alone = F.try_variant_get("listed", "$[1]", "variant").isNull()
    rows = rows.select("match_id", *carry, "_raw_json", F.when(alone, F.try_variant_get("listed", "$[0]", "variant")).alias("document"))
    odd = F.when(F.col("document").isNull() & is_json_object(), F.col("_raw_json"))
    # no filter here: Spark would move it below the parse and parse every text once more for each mention
    return rows.select("match_id", *carry, "document", odd.alias("odd"))


def _path(*names: str) -> str:
    """A path of names, which may hold one kind of quotation marks."""
    if any("'" in name and '"' in name for name in names):
        raise ValueError(f"no path of stored documents can name {names}")
    return "$" + "".join(f'["{name}"]' if "'" in name else f"['{name}']" for name in names)


def read_documents(documents: DataFrame, field_map: Mapping[str, str], types: Mapping[str, str], *carry: str) -> DataFrame:
    """Like ``parse_documents``, from stored documents: give it to the flattening as ``parse``."""
    match_level, tree = required_paths(field_map, types)

    def absent(value: Column) -> Column:
        return value.isNull() | F.is_variant_null(value)

    def is_object(value: Column) -> Column:
        # the schema of a value is told only where it has no player
        named = F.try_variant_get(value, _path("puuid"), "variant").isNotNull()
        return named | F.schema_of_variant(value).startswith("OBJECT")

    people = F.try_variant_get("document", _path("info", "participants"), "array<variant>")
    # every path of a document as text, read in one walk; an absent branch is null
    fields = f"{struct_type(match_level, as_text=True)[:-1]}, participants: ARRAY<{struct_type(tree, as_text=True)}>>"
    whole = documents.filter("document IS NOT NULL").select(
        "match_id", *carry,
        F.try_variant_get("document", _path("info"), fields).alias("texts"),
        # a list with something else than participants is none
        F.forall(people, lambda p: absent(p) | is_object(p)).alias("listed")).select(
        "match_id", *carry,
        typed_struct(F.col("texts"), match_level).alias("info"),
        F.when(F.col("listed"), F.transform(
            "texts.participants", lambda p: F.when(p.isNotNull(), typed_struct(p, tree)))).alias("participants"))
    odd = documents.filter("odd IS NOT NULL").withColumnRenamed("odd", "_raw_json")
    return whole.unionByName(parse_documents(odd, field_map, types, *carry))
