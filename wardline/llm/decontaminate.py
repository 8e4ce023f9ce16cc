"""Benchmark decontamination by template windows.

Texts are canonicalised into templates: numbers, units after (or currency
signs before) a number, and capitalised names inside a sentence become typed
placeholders; all other words are lower-cased, punctuation goes.  Windows of
``WINDOW`` template tokens are hashed and joined with the benchmark's, so a
question with other numbers or names still meets its template.  A window with
a name is hashed a second time with the name as an ordinary word, as a copy in
lower or upper case has it.  The raw
values in the slots are then compared along each alignment of the document
with the item: one item value must always stand for one document value.
Windows with a slot that breaks this do not count.  Alignments add up where
they lie close together (words put in or left out).  A document is
contaminated by an item when the windows that count cover at least
``COVERAGE`` of the item's tokens and ``LEAST`` of them (all of a shorter
item), or ``RUN`` on end (a part of a long item; single windows meet by chance
in long texts, such runs do not).

A window with under ``LITERALS`` ordinary words (signs of arithmetic between
numbers are such) says too little as a template: it is compared with its raw
values, and a second time as a template with the tokens after it, until it
holds ``LITERALS`` words, at most ``WIDEST`` tokens.  An item with fewer
tokens than a window, but ``LITERALS`` at least, is one window of its own
length; a still shorter one matches only a document of exactly its tokens.

All of it is column expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.tables import written

WINDOW = 5
LITERALS = 3
WIDEST = 20
SEGMENT = 256
COVERAGE = 0.5
LEAST = 8
RUN = 13
NEAR = 50
BROADCAST_WINDOWS = 300_000
BROADCAST_CHARS = 30_000_000

# Units by what they measure.
UNITS = {
    "length": "km m cm mm mile miles ft feet foot inch inches yard yards meter meters metre metres kilometer kilometers",
    "mass": "kg g mg lb lbs oz ton tons gram grams kilogram kilograms pound pounds ounce ounces",
    "time": "s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years",
    "money": "$ € £ usd eur gbp dollar dollars euro euros cent cents",
    "share": "% percent",
    "volume": "l ml liter liters litre litres gallon gallons",
    "speed": "mph kmh kph",
    "heat": "°c °f",
}
_DIMENSION = {unit: kind for kind, units in UNITS.items() for unit in units.split()}
_NAME, _UNIT = "\u0001", "\u0002"
_NAMES = r"\p{Lu}(?<=[\p{Ll}\p{Nd},;:] \p{Lu})\p{Ll}+"      # a capital after a word and a space
_SPACES = r"[\s\p{Z}&&[^ ]][\s\p{Z}]*+| [\s\p{Z}]++"          # white space that is not one space
_AFTER_NUMBER = r"(?<=[0-9])\s?(" + "|".join(sorted((u for u in _DIMENSION if u[0] not in "$€£"), key=lambda u: (-len(u), u))) \
    + r")(?![\p{L}\p{Nd}])"
_BEFORE_NUMBER = r"[$€£](?=\s?[0-9])"
_SIGN = r"(?<=[0-9)])\s?(=|[-+*/×÷−](?=\s?[0-9(]))"           # becomes a word: '~' sorts after ':'
_TOKENS = r"~[-+*/×÷−=]|" + _UNIT + r"[%$€£]|" + _UNIT + r"°[cf]|[" + _NAME + _UNIT + r"]?[\p{L}\p{M}]++(?:['’][\p{L}\p{M}]++)*+|[0-9]++(?:[.,][0-9]++)*+"


def marked(text: Column) -> Column:
    """The lower-cased text, white space folded, with a mark before names."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    text = F.when(text.contains(_NAME) | text.contains(_UNIT), F.translate(text, _NAME + _UNIT, "  ")).otherwise(text)
    return F.lower(F.regexp_replace(F.regexp_replace(text, _SPACES, " "), _NAMES, _NAME + "$0"))


def tokens(text: Column) -> Column:
    """Tokens of a marked text.  Ordinary words sort after ':', what fills a
    slot (marks and digits) before it."""
    units = F.regexp_replace(text, _SIGN, " ~$1 ")
    units = F.regexp_replace(F.regexp_replace(units, _AFTER_NUMBER, " " + _UNIT + "$1"), _BEFORE_NUMBER, " " + _UNIT + "$0 ")
    return F.regexp_extract_all(F.when(text.rlike("[0-9]"), units).otherwise(text), F.lit(_TOKENS), F.lit(0))


def template(raw: Column) -> Column:
    """Template tokens of raw tokens."""
    dimension = F.create_map(*[F.lit(x) for pair in _DIMENSION.items() for x in pair])

    def canonical(t):
        return F.when(t >= ":", t).when(t.startswith(_NAME), F.lit("#name")) \
            .when(t.startswith(_UNIT), F.concat(F.lit("#"), F.try_element_at(dimension, t.substr(2, 99)))) \
            .otherwise(F.lit("#num"))
    return F.transform(raw, canonical)


def unnamed(raw: Column) -> Column:
    """Raw tokens with names as ordinary words."""
    return F.transform(raw, lambda t: F.when(t.startswith(_NAME), t.substr(2, 1 << 30)).otherwise(t))


def windows(texts: DataFrame, key: str, both: bool = False, short: tuple = (), whole: bool = False) -> DataFrame:
    """A row for each window: ``key``, the text's ``total`` tokens, ``h``, the
    window's ``size``, and where it lies: its segment's first token ``start``,
    its place ``pos`` in it, and the tokens of a ``segment`` that holds a slot.

    A text is cut into segments of ``SEGMENT`` windows, and only a segment
    with a slot carries its tokens along with its hashes.  A hash runs over
    the tokens themselves; past the end of a short text there are none, so its
    one window hashes like no other.  A text without a token has one window
    of size 0, which no item has.

    With ``both``, windows with a name come a second time, ``plain``: names
    are ordinary words; and windows with too few words come again, widened.
    Besides there are windows of the sizes ``short``: those that lie inside
    longer texts, or with ``whole`` those that are the whole text.
    """
    rows = texts.select(F.col(key), marked(F.col("text")).alias("text")) \
        .select(key, F.col("text").rlike(f"[{_NAME}{_UNIT}0-9]").alias("slots"), tokens(F.col("text")).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - WINDOW, F.lit(0)), F.lit(SEGMENT))
    cut = F.transform(starts, lambda i: F.struct(F.size("all").alias("total"), i.alias("start"),
                                                 F.slice("all", i + 1, SEGMENT + WIDEST - 1).alias("raw")))
    # outer: else Spark puts a filter on the array's size below, and works the array out twice
    rows = rows.select(key, "slots", F.explode_outer(cut).alias("s")) \
        .select(key, "s.total", "s.start", "s.raw", (F.col("slots") & F.exists("s.raw", lambda t: t < ":")).alias("slots")) \
        .withColumn("canon", F.when(F.col("slots"), template(F.col("raw"))))

    def hashed(array, i):
        return F.xxhash64(*[F.get(array, i + j) for j in range(WINDOW)])

    def filled(i, raw, size=WINDOW):
        return sum((F.coalesce((F.get(raw, i + j) < ":").cast("int"), F.lit(0)) for j in range(1, size)),
                   (F.get(raw, i) < ":").cast("int"))

    def dense(i, raw="raw"):
        return filled(i, raw) > F.greatest(F.least(F.col("total"), F.lit(WINDOW)) - LITERALS, F.lit(0))

    def slotted(i, raw="raw", canon="canon"):
        return F.when(dense(i, raw), hashed(raw, i)).otherwise(hashed(canon, i))

    def window(i, h, size=WINDOW, plain=False):
        return F.struct(i.cast("int").alias("pos"), F.lit(size).cast("int").alias("size") if isinstance(size, int) else size.cast("int").alias("size"),
                        F.lit(plain).alias("plain"), h.alias("h"))

    def present(array):
        return F.filter(array, lambda w: w["h"].isNotNull())
    at = F.sequence(F.lit(0), F.greatest(F.least(F.size("raw") - WINDOW, F.lit(SEGMENT - 1)), F.lit(0)))
    own = F.least("total", F.lit(WINDOW))
    every = F.when(F.col("slots"), F.transform(at, lambda i: window(i, slotted(i), own))) \
        .otherwise(F.transform(at, lambda i: window(i, hashed("raw", i), own)))
    if both:
        named = F.col("slots") & F.exists("raw", lambda t: t.startswith(_NAME))
        rows = rows.withColumn("words", F.when(named, unnamed(F.col("raw")))) \
            .withColumn("canon_words", F.when(F.col("words").isNotNull(), template(F.col("words")))) \
            .withColumn("word_at", F.when(F.col("slots"), F.filter(F.sequence(F.lit(0), F.size("raw") - 1), lambda p: F.get("raw", p) >= ":")))

        def again(i):
            name = [F.coalesce(F.get("raw", i + j).startswith(_NAME), F.lit(False)) for j in range(WINDOW)]
            return window(i, F.when(name[0] | name[1] | name[2] | name[3] | name[4], slotted(i, "words", "canon_words")), own, True)

        def wide(i):
            size = F.when(dense(i), F.get(F.filter("word_at", lambda p: p >= i), F.lit(LITERALS - 1)) - i + 1)
            return F.struct(i.alias("pos"), size.alias("size"))
        widened = F.transform(F.filter(F.transform(at, wide), lambda w: (w["size"] > WINDOW) & (w["size"] <= WIDEST)),
                              lambda w: window(w["pos"], F.xxhash64(F.slice("canon", w["pos"] + 1, w["size"])), w["size"]))
        every = F.when(F.col("words").isNotNull(), F.concat(every, present(F.transform(at, again)), widened)) \
            .when(F.col("slots"), F.concat(every, widened)).otherwise(every)

    def brief(size):
        def at_place(i):
            literal = F.xxhash64(F.slice("raw", i + 1, size))
            return window(i, F.when(filled(i, "raw", size) > size - LITERALS, literal)
                          .otherwise(F.xxhash64(F.slice(F.coalesce("canon", "raw"), i + 1, size))), size)
        places = F.sequence(F.lit(0), F.greatest(F.least(F.size("raw") - size, F.lit(SEGMENT + WINDOW)), F.lit(0)))
        return F.transform(places, at_place)
    for size in short:
        every = F.when(F.col("total") == size if whole else F.col("total") > size, F.concat(every, brief(size))).otherwise(every)
    return rows.select(key, "total", "start", F.when(F.col("slots"), F.col("raw")).alias("segment"), every.alias("ws")) \
        .select(key, "total", "start", "segment", F.explode_outer("ws").alias("w")) \
        .select(key, "total", "start", "segment", "w.pos", "w.size", "w.plain", "w.h")


def placed(found: DataFrame) -> DataFrame:
    """``at``, ``size`` and ``raw`` of windows in place of their segment."""
    raw = F.slice("segment", F.col("pos") + 1, F.greatest("size", F.lit(0)))
    raw = F.when(F.col("plain"), unnamed(raw)).otherwise(raw)
    return found.withColumns({
        "at": F.col("start") + F.col("pos"), "raw": F.when(F.exists(raw, lambda t: t < ":"), raw)}).drop("start", "pos", "segment", "plain")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, covered`` (the item's tokens covered by windows that
    count, on alignments close together), ``coverage`` (their share of the
    item's tokens) and ``run`` (most of them on end in one alignment) of every
    document and item that share a window."""
    items = written(placed(windows(benchmark.where("item_id is not null").select("item_id", "text").distinct(), "item_id", both=True,
                                   short=tuple(range(LITERALS, WINDOW)), whole=True))
                    .where("total > 0 and h is not null").select("item_id", F.col("total").alias("item_total"), F.col("at").alias("item_at"), "h",
                            F.col("size").alias("item_size"), F.col("raw").alias("item_raw")).distinct(), "benchmark-windows")
    short = tuple(sorted(r.item_total for r in items.where(F.col("item_total").between(LITERALS, WINDOW - 1))
                         .select("item_total").distinct().collect()))
    bulk = items.agg(F.count("*"), F.coalesce(F.sum(F.length(F.array_join("item_raw", " "))), F.lit(0))).first()
    if bulk[0] <= BROADCAST_WINDOWS and bulk[1] <= BROADCAST_CHARS:
        items = F.broadcast(items)
    found = placed(windows(docs.where("doc_id is not null").select("doc_id", "text"), "doc_id", both=True, short=short)
                   .join(items, "h").where("size = item_size"))
    # an alignment: the document shifted against the item by a fixed number of tokens
    aligned = found.groupBy("doc_id", "item_id", "item_total", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set(F.struct("item_at", "size", "item_raw", "raw")).alias("ws"))

    def pairs(w):
        return F.coalesce(F.filter(F.zip_with(w["item_raw"], w["raw"], lambda a, b: F.struct(a.alias("item"), b.alias("doc"))),
                                   lambda p: p["item"] < ":"), F.array().cast("array<struct<item:string,doc:string>>"))
    slots = F.array_distinct(F.flatten(F.transform("ws", pairs)))
    values = F.transform(F.col("slots"), lambda p: p["item"])
    aligned = aligned.withColumn("slots", F.when(F.exists("ws", lambda w: w["raw"].isNotNull()), slots)
                                 .otherwise(F.array().cast("array<struct<item:string,doc:string>>")))
    broken = F.filter(F.array_distinct(values), lambda v: F.size(F.filter("slots", lambda p: p["item"] == v)) > 1)
    aligned = aligned.withColumn("broken", F.when(F.size("slots") > 1, broken).otherwise(F.array().cast("array<string>")))
    counted = F.filter("ws", lambda w: (F.size("broken") == 0) | w["item_raw"].isNull()
                       | ~F.arrays_overlap(w["item_raw"], F.col("broken")))
    covered = F.array_sort(F.array_distinct(F.flatten(
        F.transform(counted, lambda w: F.sequence(w["item_at"], w["item_at"] + w["size"] - 1)))))
    aligned = aligned.withColumn("covered", covered)

    def longer(acc, token):
        run = F.when(token == acc["last"] + 1, acc["run"] + 1).otherwise(1)
        return F.struct(token.alias("last"), run.alias("run"), F.greatest(acc["most"], run).alias("most"))
    run = F.aggregate("covered", F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most")), longer)["most"]
    # passages with words put in or left out lie on neighbouring alignments: they add up
    order = Window.partitionBy("doc_id", "item_id").orderBy("shift")
    apart = F.col("shift") - F.lag("shift").over(order) > F.col("item_total") + NEAR
    return aligned.select("doc_id", "item_id", "item_total", "shift", run.alias("run"), "covered").where(F.size("covered") > 0) \
        .withColumn("apart", F.coalesce(apart.cast("int"), F.lit(0))).withColumn("place", F.sum("apart").over(order)) \
        .select("doc_id", "item_id", "item_total", "place", "run", F.explode("covered").alias("token")) \
        .groupBy("doc_id", "item_id", "item_total", "place").agg(F.count_distinct("token").alias("n"), F.max("run").alias("run")) \
        .groupBy("doc_id", "item_id", "item_total").agg(F.max("n").alias("covered"), F.max("run").alias("run")) \
        .select("doc_id", "item_id", "item_total", "covered", (F.col("covered") / F.col("item_total")).alias("coverage"), "run")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, run: int = RUN) -> DataFrame:
    """One row per contaminated document: ``doc_id, n_items, item_ids``
    (sorted), the largest ``coverage`` and the longest ``run``.

    Null and empty texts, and items without a token, match nothing; rows
    without an id are not reported; rows that share an id are one document;
    repeated items give the same id once; an empty table on either side gives
    no rows; other columns are ignored.
    """
    hits = matches(docs, benchmark).where(
        (F.col("coverage") >= coverage) & (F.col("covered") >= F.least("item_total", F.lit(LEAST))) | (F.col("run") >= run))
    return hits.groupBy("doc_id").agg(
        F.count_distinct("item_id").alias("n_items"), F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.max("coverage").alias("coverage"), F.max("run").cast("long").alias("run"))


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, run: int = RUN) -> DataFrame:
    """``docs`` without the contaminated documents; rows without an id stay."""
    gone = written(contaminated(docs, benchmark, coverage, run).select("doc_id"), "contaminated")
    return docs.join(gone, "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
