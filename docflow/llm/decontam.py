"""Benchmark decontamination by template canonicalisation; DataFrame functions only.

Numbers, units after a number and names become typed placeholders (NUMBER, UNIT, NAME), the rest is
lower-cased without punctuation. Every capitalised word counts as a name, whatever its place and its
letters' script: a word that only begins a sentence is then a slot that keeps its value. Windows of
an item are looked up in small letters as well, so that a copy that lost its capitals is found. Windows of WINDOW canonical words of the documents are hash-joined
with those of the benchmark. For every document, item and alignment (place in the document less
place in the item) the slots of the matching windows are then compared: each value in the item must
stand for one value in the document, and each name in the document for one name in the item (two numbers may become
equal, two people may not). Of an alignment that isn't consistent only the windows without a changed slot count.
A document holds an item if the windows that count cover at least COVERAGE of the item's windows, or LONG words: verbatim
and re-parameterised copies alike. Alignments count together if their slots agree with each other as well, else the one
that covers most.

Windows of the benchmark with fewer than LITERALS literal words say too little as templates and take no part; an item with
fewer words than WINDOW is one window if it has SHORTEST words. An item without any such window is looked up by its exact
words instead, in small letters and without punctuation: in windows of WINDOW, or whole if it is shorter. An item without a
word never matches.

The benchmark's windows are broadcast only if BROADCAST_WINDOWS at most were counted, the ids of
matching documents only if BROADCAST_DOCS at most were; more are joined by shuffle. Defined cases: null texts have no window; null or repeated doc_ids are told apart
by their text's hash, repeated rows give one result row; empty tables give no rows; other columns
are ignored; whole texts are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WINDOW, SHORTEST, LITERALS, COVERAGE, LONG, BROADCAST_WINDOWS, BROADCAST_DOCS = 8, 5, 4, 0.5, 20, 200_000, 200_000
#: Placeholders; a digit first, so that no canonical word can be one.
NUMBER, UNIT, NAME = "0n", "0u", "0a"
#: Units recognised after a number.
UNITS = (
    "mm cm m km meter meters metre metres in inch inches ft foot feet yd yard yards mi mile miles "
    "mg g kg t gram grams kilogram kilograms ton tons tonnes oz ounce ounces lb lbs pound pounds "
    "ml cl l liter liters litre litres gallon gallons pint pints cup cups "
    "ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "km/h mph kmh hz khz mhz ghz w kw mw v volt volts amp amps joule joules kj cal kcal pa bar psi "
    "usd eur dollar dollars cent cents euro euros percent degrees degree"
)
UNIT_PATTERN = "|".join(sorted(UNITS.split(), key=lambda u: (-len(u), u)))
#: Rules applied in order, pattern and replacement ($1 stands for the first group).
RULES = (
    (r"[0-9]+(?:[.,][0-9]+)*", NUMBER),
    (rf"(0n ?)(?:{UNIT_PATTERN})\b", "$1" + UNIT),
    # A name is a word that begins with a capital letter and holds a small one.
    (r"(^|[^\p{L}\p{N}])\p{Lu}\p{L}*\p{Ll}\p{L}*", "$1" + NAME),
)
PUNCTUATION = ".,;:!?\"'()[]{}"
SPLIT, SPACES = r"[\x20\x09-\x0D]+", " \t\n\r\x0b\x0c"


def canonical(text: Column) -> Column:
    for pattern, to in RULES:
        text = F.regexp_replace(text, pattern, to)
    return F.lower(text)


def words(text: Column) -> Column:
    """Words without punctuation; the same places for a text and its canonical form, as rules keep all white space."""
    return F.split(F.btrim(F.translate(text, PUNCTUATION, ""), F.lit(SPACES)), SPLIT)


def is_slot(word: Column) -> Column:
    return word.contains(NUMBER) | word.contains(UNIT) | word.contains(NAME)


def let(x: Column, body) -> Column:
    """body(x) with x evaluated once, however often body names it."""
    return F.get(F.transform(F.array(x), lambda v: body(v)), F.lit(0))


def window_hashes(w: Column, size: int) -> Column:
    """The hashes of all windows of the size, by place: those of one word, doubled, then two that overlap."""
    step = 1 << (size.bit_length() - 1)

    def pairs(h: Column, apart: int) -> Column:
        return F.zip_with(F.slice(h, F.lit(1), F.size(h) - apart), F.slice(h, F.lit(apart + 1), F.size(h) - apart), lambda x, y: F.xxhash64(x, y))

    def doubled(h: Column, have: int) -> Column:
        if have < step:
            return let(pairs(h, have), lambda g: doubled(g, 2 * have))
        return h if have == size else pairs(h, size - have)

    return F.when(F.size(w) >= size, let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: doubled(h, 1))).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, size, ipos, hash, window, values and n_windows of the items' windows."""
    items = benchmark.where("text is not null").select(F.col("item_id"), F.col("text").cast("string").alias("text"))
    low = words(canonical(F.lower("text")))  # a copy in small letters has no name left
    items = items.select("item_id", words(canonical(F.col("text"))).alias("w"), low.alias("low"), words(F.lower("text")).alias("raw"))
    items = items.withColumn("size", F.least(F.lit(WINDOW), F.size("w")))
    literal = F.transform("w", lambda x: F.when(is_slot(x), 0).otherwise(1))
    said = F.exists(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1), lambda i: F.aggregate(F.slice(literal, i, F.col("size")), F.lit(0), lambda n, x: n + x) >= LITERALS)
    items = items.withColumn("exact", ~((F.col("size") >= SHORTEST) & said)).where(~F.col("exact") | (F.col("raw") != F.array(F.lit(""))))

    def hashes(w: str) -> Column:
        out = F.array().cast("array<bigint>")
        for n in range(1, WINDOW + 1):
            out = F.when(F.col("size") == n, window_hashes(F.col(w), n)).otherwise(out)
        return out

    def at(w: str) -> Column:
        return F.slice(w, F.col("ipos") + 1, F.col("size"))

    both = F.when(F.col("exact"), F.arrays_zip(hashes("raw").alias("w"), hashes("raw").alias("low"))).otherwise(F.arrays_zip(hashes("w").alias("w"), hashes("low").alias("low")))
    rows = items.select("item_id", "exact", "size", *(F.when(F.col("exact"), F.col("raw")).otherwise(F.col(c)).alias(c) for c in ("w", "low")), "raw", F.posexplode(both).alias("ipos", "h"))
    rows = rows.select("item_id", "exact", "size", "ipos", "h", at("w").alias("w"), at("low").alias("low"), at("raw").alias("values"))
    rows = rows.where(F.col("exact") | (F.size(F.filter("w", lambda x: ~is_slot(x))) >= LITERALS))
    forms = F.array_distinct(F.array(F.struct(F.col("h.w").alias("hash"), F.col("w").alias("window")), F.struct(F.col("h.low").alias("hash"), F.col("low").alias("window"))))
    rows = rows.select("item_id", "exact", "size", "ipos", "values", F.explode(forms).alias("form")).select("item_id", "exact", "size", "ipos", "form.hash", "form.window", "values")
    total = rows.groupBy("item_id").agg(F.count_distinct("ipos").alias("n_windows"))
    return rows.join(total, rows["item_id"].eqNullSafe(total["item_id"])).drop(total["item_id"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_matched, n_windows and reparameterised of every document that holds an item (th: the text's hash)."""
    bench = written(benchmark_windows(benchmark), "benchmark-windows")
    sizes = bench.groupBy("exact", "size").count().collect()  # at most twelve
    if not sizes:
        return docs.sparkSession.createDataFrame([], f"doc_id long, th long, item_id {dict(benchmark.dtypes)['item_id']}, n_matched long, n_windows long, reparameterised boolean")
    few = sum(r["count"] for r in sizes) <= BROADCAST_WINDOWS
    base = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))

    def windows(w: Column, exact: bool) -> list[Column]:
        """An array of a text's windows for every size of this kind, all from one list of words."""
        own = sorted(r["size"] for r in sizes if r["exact"] == exact)
        of = lambda x, n: F.transform(window_hashes(x, n), lambda h, i: F.struct(F.lit(exact).alias("exact"), F.lit(n).alias("size"), i.alias("pos"), h.alias("hash")))
        return [let(w, lambda x: F.concat(*(of(x, n) for n in own)))] if own else []

    every = F.concat(*windows(words(canonical(F.col("text"))), False), *windows(words(F.lower("text")), True))
    rows = base.select("doc_id", "th", F.explode(every).alias("x")).select("doc_id", "th", "x.*")
    found = rows.join(F.broadcast(bench) if few else bench, ["exact", "size", "hash"]).select("doc_id", "th", "pos", "item_id", "ipos", "n_windows", "size", "window", "values")
    # Slots as (item's value, document's value); equal literal words are equal by the hash. A document's
    # own words are cut once, for all its matching windows that have a slot.
    found = written(found, "template-matches")
    slotted = F.exists("window", is_slot)
    base = only(base, found.where(slotted).select("doc_id", "th").distinct(), "left_semi")
    asked = found.where(slotted).groupBy("doc_id", "th").agg(F.collect_set(F.struct("pos", "item_id", "ipos", "size", "window", "values")).alias("hits"))
    cut = base.join(asked.select(F.col("doc_id").alias("_d"), F.col("th").alias("_h"), "hits"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_h")))

    def slots(raw: Column, hit: Column) -> Column:
        got = F.slice(raw, hit["pos"] + 1, hit["size"])
        both = F.zip_with(F.arrays_zip(hit["window"].alias("type"), hit["values"].alias("of")), got, lambda x, y: F.struct(x["type"].alias("type"), x["of"].alias("of"), y.alias("to")))
        return F.struct(hit["item_id"].alias("item_id"), (hit["pos"] - hit["ipos"]).alias("shift"), hit["ipos"].alias("ipos"), F.filter(both, lambda x: is_slot(x["type"])).alias("pairs"))

    each = cut.select("doc_id", "th", F.explode(let(words(F.lower("text")), lambda raw: F.transform("hits", lambda h: slots(raw, h)))).alias("x")).select("doc_id", "th", "x.*")
    moved = F.collect_set(F.when(F.exists("pairs", lambda x: x["of"] != x["to"]), F.col("ipos")))
    pairs = each.groupBy("doc_id", "th", "item_id", "shift").agg(F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"), moved.alias("moved"))
    places = found.groupBy("doc_id", "th", "item_id", "n_windows", (F.col("pos") - F.col("ipos")).alias("shift")).agg(F.collect_set("ipos").alias("places"))
    named = pairs.select(F.col("doc_id").alias("_d"), F.col("th").alias("_h"), F.col("item_id").alias("_i"), F.col("shift").alias("_s"), "pairs", "moved")
    aligned = places.join(named, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_h")) & F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("shift") == F.col("_s")), "left")
    aligned = aligned.withColumn("pairs", F.coalesce("pairs", F.array().cast("array<struct<type:string,of:string,to:string>>")))
    names = F.filter("pairs", lambda x: x["type"].contains(NAME))
    one_each = (F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda x: F.struct(x["type"], x["of"]))))) & (F.size(names) == F.size(F.array_distinct(F.transform(names, lambda x: F.struct(x["type"], x["to"])))))
    aligned = aligned.withColumn("whole", one_each)
    aligned = aligned.withColumn("places", F.when(F.col("whole"), F.col("places")).otherwise(F.array_except("places", "moved"))).where(F.size("places") > 0)
    aligned = aligned.withColumn("pairs", F.when(F.col("whole"), F.col("pairs")).otherwise(F.filter("pairs", lambda x: x["of"] == x["to"])))
    agree = F.array_distinct(F.flatten(F.collect_list("pairs")))
    one = F.struct(F.size("places").alias("n"), F.exists("pairs", lambda x: x["of"] != x["to"]).alias("changed"))
    held = aligned.groupBy("doc_id", "th", "item_id", "n_windows").agg(
        agree.alias("pairs"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"), F.max(one).alias("best"), F.max(one["changed"]).alias("changed")
    )
    held = held.select(
        "doc_id", "th", "item_id", "n_windows",
        F.when(one_each, F.col("n")).otherwise(F.col("best.n")).cast("long").alias("n_matched"), F.when(one_each, F.col("changed")).otherwise(F.col("best.changed")).alias("reparameterised"),
    )
    enough = (F.col("n_matched") >= F.ceil(F.col("n_windows") * COVERAGE)) | (F.col("n_matched") >= LONG - WINDOW + 1)
    return held.where(enough).select("doc_id", "th", "item_id", "n_matched", "n_windows", "reparameterised")


def only(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """docs joined (left_semi or left_anti) with ids (doc_id, th), which are broadcast if they are few: texts then stay where they are."""
    ids = written(ids.select(F.col("doc_id").alias("_gone"), F.col("th").alias("_th")), "template-ids")
    same = docs["doc_id"].cast("long").eqNullSafe(ids["_gone"]) & (F.xxhash64(docs["text"].cast("string")) == ids["_th"])
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_DOCS else ids, same, how)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold an item, all columns kept."""
    return only(docs, contaminated(docs, benchmark).select("doc_id", "th").distinct(), "left_anti")
