"""Benchmark decontamination by canonical templates, in SQL functions only.

Texts become words in lower case; numbers, units after a number and capitalised words
keep a mark of their type. A window of ``WINDOW`` tokens has two keys, in which numbers
and units are placeholders: one with every capitalised word a placeholder too, one with
all of them literal, whatever their case. A window of more numbers and units than words has a
third one instead, with all values. The benchmark's keys are hash-joined with those
at every position of every document, so a copy is met in other case or layout, and with
other names at the same places. A match only proposes an alignment of a document with
an item, which is then read word by word over the whole item:

- words agree if they are equal without case, or both are numbers, or units; a word seen
  as a name (capitalised inside a sentence) anywhere in the item agrees with any word at
  all its places, and a capitalised one with any capitalised word;
- on each alignment a value of the item must stand for one and the same value everywhere
  (and different names for different names), so a question with other numbers and names
  is caught and a table that only looks alike is not. Only windows that hold a changed
  place of a value that breaks this are dropped.

A document is contaminated by an item if consistent windows cover ``COVER`` of the
item's windows or more, or if consecutive ones on one alignment span ``RUN`` tokens. Windows
that agree word by word and value by value count whatever they hold.

The benchmark's keys are broadcast only if their counted number is within
``BROADCAST_WINDOWS``; beyond that Spark joins by shuffling, with the same result.

Cases: null and empty texts are clean; an item shorter than a window is one window of
its own length; an item under ``LEAST_TOKENS`` tokens is too common to condemn a text by:
how many of them a text holds verbatim is told in a column of its own; windows in which
names and numbers are over half are left out of the item's windows, unless the names
agree as words, which is rated as a share of the windows with less than half numbers, or all
values agree, which is rated as a share of all windows; an item without a token is nowhere;
items that repeat are matched each; rows that repeat a document are judged by their own
text, null ids included; an empty benchmark leaves all clean; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import pick, stage

WINDOW = 8
COVER = 0.5
# Consecutive tokens that are a leak whatever share of the item they are.
RUN = 13
LEAST_TOKENS = 4
BROADCAST_WINDOWS = 1_000_000
# Unit words that count as units after a number.
UNITS = (
    "km", "m", "cm", "mm", "mi", "miles", "mile", "ft", "feet", "foot", "in", "inches", "inch", "yards", "meters",
    "kilometers", "kg", "g", "mg", "lb", "lbs", "pounds", "grams", "kilograms", "ounces", "oz", "l", "ml", "liters",
    "litres", "gallons", "s", "sec", "seconds", "min", "minutes", "h", "hr", "hours", "hour", "days", "day", "weeks",
    "week", "months", "years", "year", "percent", "dollars", "cents", "euros", "usd", "eur", "mph", "kmh", "degrees",
)
# Marks in front of a value: d number, u unit, n name, s capitalised word at the start of a sentence (of items only).
_MARK = "\u0001"
_CAPITAL = r"(?<![\p{L}\p{M}\p{N}].)\p{Ll}+"
_GAP = r"[\s\p{Zs}]"


def tokens(text: Column, item: bool = False) -> Column:
    """Words in lower case; a number, unit or capitalised word is a mark, the letter of its type and its value."""
    plain = F.translate(F.coalesce(text, F.lit("")), _MARK, " ")
    if item:
        plain = F.regexp_replace(plain, rf"{_GAP}+", " ")
        plain = F.regexp_replace(plain, r"\p{Lu}(?<=[\p{Ll}\p{Nd},;:] .)\p{Ll}+", f" {_MARK}n$0")
        named = F.regexp_replace(plain, rf"\p{{Lu}}{_CAPITAL}", f" {_MARK}s$0")
    else:
        named = F.regexp_replace(plain, rf"\p{{Lu}}{_CAPITAL}", f" {_MARK}n$0")
    lower = F.lower(named)
    joined = F.regexp_replace(lower, r"(\p{Nd})[.,](?=\p{Nd})", "$1")
    units = F.regexp_replace(
        joined, rf"(\p{{Nd}}){_GAP}*(?:{_MARK}[ns])?({'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{Nd}}])", f"$1 {_MARK}u$2")
    numbers = F.regexp_replace(units, r"\p{Nd}+", f" {_MARK}d$0 ")
    marked = F.when(lower.rlike(r"\p{Nd}"), numbers).otherwise(lower)
    return F.array_remove(F.split(marked, rf"[^\p{{L}}\p{{M}}\p{{N}}{_MARK}]+"), "")


def _amount(token: Column) -> Column:
    """Whether a token is a number or a unit."""
    return token.startswith(f"{_MARK}d") | token.startswith(f"{_MARK}u")


def _capital(token: Column) -> Column:
    return token.startswith(f"{_MARK}n") | token.startswith(f"{_MARK}s")


def _word(token: Column) -> Column:
    """The token without the mark of a capitalised word."""
    return F.when(_capital(token), F.substring(token, 3, 1 << 30)).otherwise(token)


def typed_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(F.when(~w.startswith(_MARK), w).when(
        _capital(w), F.lit(f"{_MARK}n")).otherwise(F.substring(w, 1, 2))))


def literal_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(F.when(~w.startswith(_MARK), w).when(
        _capital(w), _word(w)).otherwise(F.substring(w, 1, 2))))


def exact_hashes(words: Column) -> Column:
    """With the values of numbers and units."""
    return F.transform(words, lambda w: F.xxhash64(_word(w)))


def _key(hashes: str, size: int) -> Column:
    seed = -size if hashes == "exact" else size
    return F.xxhash64(F.lit(seed), *(F.get(hashes, F.col("at") + k) for k in range(size)))


def _places(rows: DataFrame, size: int) -> DataFrame:
    """A row per place ``at`` (from 0) at which a window of ``size`` tokens starts."""
    # no filter before it, which would take the texts apart a second time
    starts = F.when(F.size("typed") >= size, F.sequence(F.lit(0), F.size("typed") - size))
    return rows.withColumn("at", F.explode(starts))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, also where ``then`` reads it in a loop."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _starts(n: Column, size: Column) -> Column:
    return F.sequence(F.lit(0), n - size)


def _half(flags: Column, size: Column) -> Column:
    """For each window, whether half of its places or more are flagged."""
    return _let(flags, lambda f: F.transform(
        _starts(F.size(f), size), lambda s: 2 * F.size(F.filter(F.slice(f, s + 1, size), lambda x: x)) >= size))


def _all(flags: Column, size: Column) -> Column:
    """For each window, whether all its places are flagged."""
    return _let(flags, lambda f: F.transform(
        _starts(F.size(f), size), lambda s: F.forall(F.slice(f, s + 1, size), lambda x: x)))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Per item: ``words``, ``names`` seen in it, window ``size``, and of each window whether it is ``strong``
    (half of it neither names nor numbers) and ``wordy`` (half of it no numbers)."""
    rows = pick(benchmark, "item_id", "text").select(
        "item_id", F.xxhash64("item_id", "text").alias("item"), tokens(F.col("text"), item=True).alias("words"))
    rows = rows.where(F.size("words") > 0).dropDuplicates(["item_id", "item"])
    names = F.array_distinct(F.transform(F.filter("words", lambda w: w.startswith(f"{_MARK}n")), _word))
    rows = stage(rows.withColumns({"names": names, "size": F.least(F.size("words"), F.lit(WINDOW))}), "item_words")
    literal = F.transform("words", lambda w: ~_amount(w) & ~F.array_contains("names", _word(w)))
    return rows.withColumns({
        "strong": _half(literal, F.col("size")), "wordy": _half(F.transform("words", lambda w: ~_amount(w)), F.col("size"))})


def short_items(items: DataFrame) -> DataFrame:
    """``key``, ``size`` and ``item_id`` of the items that are too short to be evidence."""
    rows = items.where(F.col("size") < LEAST_TOKENS).withColumns({"exact": exact_hashes(F.col("words")), "at": F.lit(0)})
    keys = [F.when(F.col("size") == n, _key("exact", n)) for n in range(1, LEAST_TOKENS)]
    return rows.select(F.coalesce(*keys).alias("key"), "size", "item_id").distinct()


def item_keys(items: DataFrame) -> DataFrame:
    """``key``, ``size``, ``item``, ``item_id`` and ``item_at`` of windows that may propose an alignment."""
    rows = items.withColumns({
        "typed": typed_hashes(F.col("words")), "literal": literal_hashes(F.col("words")), "exact": exact_hashes(F.col("words"))})
    # names as such only where they stand inside a sentence
    rows = rows.withColumn("told", _half(F.transform("words", lambda w: ~_amount(w) & ~w.startswith(f"{_MARK}n")), F.col("size")))
    parts = []
    for size in range(LEAST_TOKENS, WINDOW + 1):
        found = _places(rows.where(F.col("size") == size), size)
        keys = F.array_compact(F.array(
            F.when(F.get("told", F.col("at")), _key("typed", size)), F.when(F.get("wordy", F.col("at")), _key("literal", size)),
            F.when(~F.get("wordy", F.col("at")), _key("exact", size))))
        parts.append(found.select(
            F.explode(F.array_distinct(keys)).alias("key"), F.lit(size).alias("size"), "item", "item_id", F.col("at").alias("item_at")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def proposed(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Alignments ``doc_id``, ``text_key``, ``item``, ``item_id``, ``shift`` on which some window matches."""
    sizes = [r["size"] for r in keys.select("size").distinct().collect()]  # WINDOW values at most
    side = F.broadcast(keys) if keys.count() <= BROADCAST_WINDOWS else keys
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), tokens(F.col("text")).alias("words"))
    # most texts have too few numbers for a window of more numbers than words
    amounts = F.size(F.filter("words", _amount))
    rows = rows.select(
        "doc_id", "text_key", typed_hashes(F.col("words")).alias("typed"), literal_hashes(F.col("words")).alias("literal"),
        F.when(2 * amounts > LEAST_TOKENS, exact_hashes(F.col("words"))).alias("exact"))
    found = None
    for size in sorted(sizes, reverse=True) or [WINDOW]:
        # nothing here may take a loop over elements, which would copy the texts' arrays for every place
        usual = _key("typed", size), _key("literal", size)
        keys = F.when(F.col("exact").isNull(), F.array(*usual)).otherwise(F.array(*usual, _key("exact", size)))
        both = F.explode(F.array_distinct(keys))
        part = _places(rows, size).select("doc_id", "text_key", "at", both.alias("key"))
        part = part.join(side.where(F.col("size") == size).drop("size"), "key").select(
            "doc_id", "text_key", "item", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def short_matches(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and how many short items (``n_short_items``) a text holds verbatim."""
    sizes = [r["size"] for r in keys.select("size").distinct().collect()]  # LEAST_TOKENS values at most
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), tokens(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "text_key", exact_hashes(F.col("words")).alias("exact"))
    side = F.broadcast(keys) if keys.count() <= BROADCAST_WINDOWS else keys
    found = None
    for size in sizes:
        starts = F.when(F.size("exact") >= size, F.sequence(F.lit(0), F.size("exact") - size))
        held = rows.withColumn("at", F.explode(starts)).select("doc_id", "text_key", _key("exact", size).alias("key")).distinct()
        part = held.join(side.where(F.col("size") == size).drop("size"), "key").select("doc_id", "text_key", "item_id")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "text_key").agg(F.count_distinct("item_id").alias("n_short_items"))


def _agreement(theirs: Column, ours: Column, names: Column) -> Column:
    """How a word of an item and one of a document agree: ``exact``, by ``type``, and the two values."""
    a, b = _word(theirs), _word(ours)
    alike = (F.substring(theirs, 1, 2) == F.substring(ours, 1, 2)) & _amount(theirs)
    named = ~_amount(theirs) & ~_amount(ours) & (F.array_contains(names, a) | (_capital(theirs) & _capital(ours)))
    no = F.lit(False)
    return F.struct(
        F.coalesce(a == b, no).alias("exact"), F.coalesce(alike | named, no).alias("type"), a.alias("a"), b.alias("b"),
        (~_amount(theirs) & (_capital(theirs) | F.array_contains(names, a))).alias("name"))


def _reading() -> Column:
    """Of an alignment of ``words`` with ``ours``: starts of its consistent windows, ``strong`` and with enough
    equal words (``worded``), those equal in all values (``exact``), tokens of the longest ``run`` of them, and
    whether all of the first two are ``verbatim``."""
    size, n = F.col("size"), F.size("words")
    places = F.zip_with("words", "ours", lambda t, o: _agreement(t, o, F.col("names")))

    def values(places: Column, matched: Column) -> Column:
        """What the places inside matched windows stand for."""
        inside = lambda p: F.exists(
            F.slice(matched, F.greatest(p - size + 2, F.lit(1)), F.least(p + 1, size)), lambda m: m)
        typed = F.filter(places, lambda x, p: x["type"] & inside(p))
        return F.array_distinct(F.transform(typed, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["name"].alias("name"))))

    def clashes(values: Column) -> Column:
        return F.filter(values, lambda x: F.exists(values, lambda y: (
            ((x["a"] == y["a"]) & (x["b"] != y["b"])) | (x["name"] & y["name"] & (x["b"] == y["b"]) & (x["a"] != y["a"])))))

    def consistent(places: Column, broken: Column) -> Column:
        """Windows without a place at which one of the broken values was changed."""
        fits = lambda x: x["exact"] | (x["type"] & ~F.exists(broken, lambda y: (x["a"] == y["a"]) & (x["b"] == y["b"])))
        return _all(F.transform(places, fits), size)

    def longest(good: Column, enough: Column, equal: Column) -> Column:
        """Tokens of the longest run of consecutive windows that tell."""
        zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

        def step(so_far: Column, s: Column) -> Column:
            tells = F.get(equal, s) | (F.get(good, s) & (F.get("strong", s) | F.get(enough, s)))
            now = F.when(tells, so_far["now"] + 1).otherwise(0)
            return F.struct(now.alias("now"), F.greatest(so_far["most"], now).alias("most"))

        return F.aggregate(_starts(n, size), zero, step, lambda r: F.when(r["most"] > 0, r["most"] + size - 1).otherwise(0))

    def report(places: Column, good: Column) -> Column:
        worded = _half(F.transform(places, lambda x: x["exact"] & ~_amount(x["a"])), size)
        some = lambda flags: F.filter(_starts(n, size), lambda s: F.get(good, s) & flags(s))
        strong = some(lambda s: F.get("strong", s))
        verbatim = _all(F.transform(places, lambda x: x["exact"]), size)
        return _let(worded, lambda enough: _let(verbatim, lambda equal: F.struct(
            strong.alias("strong"), some(lambda s: F.get("wordy", s) & F.get(enough, s)).alias("worded"),
            F.filter(_starts(n, size), lambda s: F.get(equal, s)).alias("exact"), longest(good, enough, equal).alias("run"),
            F.forall(some(lambda s: F.get("strong", s) | F.get(enough, s)), lambda s: F.get(equal, s)).alias("verbatim"))))

    return _let(places, lambda p: _let(_all(F.transform(p, lambda x: x["exact"] | x["type"]), size), lambda m: _let(
        values(p, m), lambda v: _let(clashes(v), lambda c: _let(consistent(p, c), lambda g: report(p, g))))))


def aligned(proposals: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per alignment its ``reading``."""
    doc = ["doc_id", "text_key"]
    listed = proposals.groupBy(*doc).agg(F.collect_list(F.struct("item", "item_id", "shift")).alias("found"))
    listed = listed.withColumnsRenamed({c: f"_{c}" for c in doc})
    texts = docs.withColumn("text_key", F.xxhash64("text"))
    # document ids may be null, so documents are told apart by null-safe equality
    met = texts.join(listed, [texts[c].eqNullSafe(listed[f"_{c}"]) for c in doc]).dropDuplicates(doc)
    met = stage(met.select(*doc, tokens(F.col("text")).alias("all"), "found"), "matched_texts")
    rows = met.select(*doc, "all", F.explode("found").alias("f")).select(*doc, "f.item", "f.item_id", "f.shift", "all")
    rows = rows.join(items.drop("item_id").dropDuplicates(["item"]), "item")
    ours = F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda p: F.get("all", p + F.col("shift")))
    rows = stage(rows.withColumn("ours", ours).drop("all"), "passages")
    return rows.select(*doc, "item", "item_id", _reading().alias("reading"))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text), ``item_id``, ``cover`` and ``verbatim`` of contaminated pairs."""
    return _pairs(stage(benchmark_items(benchmark), "items"), docs, cover)


def _pairs(items: DataFrame, docs: DataFrame, cover: float) -> DataFrame:
    items = items.where(F.col("size") >= LEAST_TOKENS)
    docs = pick(docs, "doc_id", "text")
    proposals = stage(proposed(docs, stage(item_keys(items), "item_keys")), "alignments")
    found = aligned(proposals, docs, items)
    distinct = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    covered = found.groupBy("doc_id", "text_key", "item", "item_id").agg(
        F.max("reading.run").alias("run"), distinct("reading.strong").alias("s"), distinct("reading.worded").alias("w"), distinct("reading.exact").alias("e"), F.bool_and("reading.verbatim").alias("verbatim"))
    totals = items.select(
        "item", F.size("strong").alias("n_all"), *(F.size(F.filter(c, lambda x: x)).alias(f"n_{c}") for c in ("strong", "wordy")))
    part = lambda n, of: F.when(F.col(of) > 0, F.col(n) / F.col(of))
    share = covered.join(totals, "item").withColumn("cover", F.greatest(part("s", "n_strong"), part("w", "n_wordy"), part("e", "n_all")))
    return share.where((F.col("cover") >= cover) | (F.col("run") >= RUN)).select("doc_id", "text_key", "item_id", "cover", "verbatim")


def decontaminate(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """All rows of ``docs`` with ``contaminated``, ``n_items``, ``first_item``, ``best_cover`` and ``n_short_items``
    behind their columns."""
    items = stage(benchmark_items(benchmark), "items")
    pairs = _pairs(items, docs, cover)
    found = pairs.groupBy("doc_id", "text_key").agg(
        F.count_distinct("item_id").alias("n_items"), F.min("item_id").alias("first_item"), F.max("cover").alias("best_cover"))
    short = stage(short_items(items), "short_items")
    if short.isEmpty():
        found = found.withColumn("n_short_items", F.lit(0).cast("long"))
    else:
        held = short_matches(pick(docs, "doc_id", "text"), short)
        same = [found[c].eqNullSafe(held[c]) for c in ("doc_id", "text_key")]
        found = found.join(held, same, "full").select(
            *(F.coalesce(found[c], held[c]).alias(c) for c in ("doc_id", "text_key")),
            "n_items", "first_item", "best_cover", "n_short_items")
    found = stage(found.withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"}), "contaminated")
    rows = docs.drop("n_items", "first_item", "best_cover", "contaminated", "n_short_items").withColumn("_key", F.xxhash64("text"))
    joined = rows.join(found, rows["doc_id"].eqNullSafe(F.col("_doc_id")) & (F.col("_key") == F.col("_text_key")), "left")
    return joined.drop("_doc_id", "_text_key", "_key").withColumns({
        "contaminated": F.col("n_items").isNotNull(), "n_items": F.coalesce("n_items", F.lit(0)).cast("long"),
        "n_short_items": F.coalesce("n_short_items", F.lit(0)).cast("long")})
