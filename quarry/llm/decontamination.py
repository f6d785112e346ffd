"""Benchmark decontamination: prefix-filtered set join (DataFrame functions only).

An item is cut into windows of ``window`` consecutive words, a window into
word shingles. A document holds a window only if it holds every shingle of it,
so one necessary token per window - the prefix of length one that containment
1 leaves - is enough to find all candidates:

1. one pass over the texts keeps the shingles that occur in the benchmark,
   with their positions (and one marker row per document);
2. shingles are ordered by rarity, their number of occurrences over all
   documents, and each window takes its rarest shingle as prefix token;
3. the prefix tokens are joined to the kept positions; the token's offset in
   the window fixes where the window would start, and a start before the
   document or an end behind it is dropped (positional and length bounds);
4. what remains is verified exactly, word for word, against the kept shingles
   that tile the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved

#: Words of lower-cased text, and the same words before lower-casing A-Z.
WORD_RE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD_RE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Benchmark side rows up to which it is broadcast (a row is some 50 bytes).
BROADCAST_ROWS = 500_000


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _small(df: DataFrame) -> DataFrame:
    """``df`` (a written table), with a broadcast hint if its counted rows are
    within the bound; beyond it the join shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _key(words: list[Column]) -> Column:
    """Equal for shingles that are equal after lower-casing A-Z; the text is compared behind it."""
    return F.xxhash64(*[F.lower(w) for w in words])


def benchmark_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item_id, w: window text, len, k, offset, s: shingle text, h: key), a
    row for each shingle of each window; repeated windows of an item once."""
    words = F.regexp_extract_all(ascii_lower("text"), F.lit(WORD_RE), F.lit(0))
    parted = (items.select("item_id", words.alias("words")).filter(F.size("words") > 0)
              .withColumn("len", F.least(F.lit(window), F.size("words")))
              .withColumn("k", F.least(F.lit(shingle), F.col("len")))
              .withColumn("start", F.explode(F.expr("sequence(1, size(words) - len + 1)")))
              .select("item_id", "len", "k", F.slice("words", F.col("start"), F.col("len")).alias("words"))
              .withColumn("w", F.array_join("words", " ")).dropDuplicates(["item_id", "w"]))
    return (parted.withColumn("offset", F.explode(F.expr("sequence(0, len - k)")))
            .withColumn("part", F.slice("words", F.col("offset") + 1, F.col("k")))
            .select("item_id", "w", "len", "k", "offset", F.array_join("part", " ").alias("s"),
                    F.xxhash64(*[F.lower(F.get("part", F.lit(i))) for i in range(shingle)]).alias("h")))


def _positions(docs: DataFrame, wanted: DataFrame, k: int, markers: bool) -> DataFrame:
    """Positions of the wanted ``k``-word shingles: (rid, doc_id, n_words,
    pos, s). With ``markers`` every document has a row at position 0 or null."""
    tail = [F.slice("words", i + 1, F.greatest(F.size("words"), F.lit(1))) for i in range(1, k)]
    zipped = F.arrays_zip(F.col("words"), *tail) if k > 1 else F.transform("words", lambda w: F.struct(w))
    rows = docs.select("rid", "doc_id", F.size("words").alias("n_words"),
                       F.posexplode_outer(zipped).alias("pos", "z"))
    names = rows.schema["z"].dataType.names
    parts = [F.col("z").getField(n) for n in names]
    rows = rows.select("rid", "doc_id", "n_words", "pos", *[p.alias(f"w{i}") for i, p in enumerate(parts)])
    ws = [F.col(f"w{i}") for i in range(k)]
    rows = rows.withColumn("h", F.when(ws[-1].isNotNull(), _key(ws)))
    side = _small(wanted.filter(F.col("k") == k).select("h", "s").distinct())
    same = (rows["h"] == side["h"]) & (ascii_lower(F.concat_ws(" ", *ws)) == side["s"])
    found = rows.join(side, same, "left" if markers else "inner")
    if markers:
        found = found.filter(side["s"].isNotNull() | F.col("pos").isNull() | (F.col("pos") == 0))
    return found.select("rid", "doc_id", "n_words", "pos", side["s"])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit (words inside
    an occurrence of an item's window), n_items, item_ids (sorted as strings),
    items_sha256, contaminated.

    ``items`` has item_id, text. A null or empty text has no words: such a
    document is never hit, such an item never occurs. An item of fewer than
    ``window`` words is one window. Repeated documents are judged each for
    itself, repeated items all count; rows of one item_id make one item.
    Empty tables give no hit or no row. Other columns are not read."""
    bench = saved(benchmark_windows(items, window, shingle), "benchmark-windows")
    texts = (docs.select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RAW_WORD_RE), F.lit(0))
                         .alias("words")).withColumn("rid", F.monotonically_increasing_id()))
    short = [r.k for r in bench.filter(F.col("k") < shingle).select("k").distinct().collect()]  # fewer than ``shingle`` values
    found = _positions(texts, bench, shingle, markers=True)
    for k in short:
        found = found.unionByName(_positions(texts, bench, k, markers=False).withColumn("pos", F.col("pos")))
    found = saved(found, "benchmark-positions")
    hits = found.filter(F.col("s").isNotNull()).select("rid", "n_words", "pos", "s")

    rarity = hits.groupBy("s").agg(F.count(F.lit(1)).alias("freq"))
    # A window with a shingle that no document has cannot occur: it stays out by the inner join and the count.
    prefix = (bench.select("w", "len", "k", "offset", "s").distinct().join(rarity, "s")
              .groupBy("w", "len", "k").agg(F.min(F.struct("freq", "s", "offset")).alias("rarest"), F.count(F.lit(1)).alias("have"))
              .filter(F.col("have") == F.col("len") - F.col("k") + 1)
              .select("w", "len", "k", F.col("rarest.s").alias("s"), F.col("rarest.offset").alias("offset")))
    prefix = _small(saved(prefix, "benchmark-prefix"))
    candidates = (hits.join(prefix, "s").withColumn("start", F.col("pos") - F.col("offset"))
                  .filter((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
                  .select("rid", "start", "w", "len", "k"))

    # Exact check: the shingles at 0, k, 2k, ... and the last one cover the window.
    tiles = F.array_distinct(F.concat(F.expr("sequence(0, len - k, k)"), F.array(F.col("len") - F.col("k"))))
    parts = (candidates.withColumn("n_tiles", F.size(tiles)).withColumn("offset", F.explode(tiles))
             .withColumn("pos", F.col("start") + F.col("offset"))
             .withColumn("s", F.array_join(F.slice(F.split("w", " "), F.col("offset") + 1, F.col("k")), " ")))
    occurrences = saved(parts.join(hits.select("rid", "pos", "s"), ["rid", "pos", "s"], "left_semi")
                        .groupBy("rid", "start", "w", "len", "n_tiles").agg(F.count(F.lit(1)).alias("n"))
                        .filter(F.col("n") == F.col("n_tiles")).select("rid", "start", "w", "len"),
                        "benchmark-occurrences")

    before = Window.partitionBy("rid").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    covered = (occurrences.withColumn("done", F.coalesce(F.max(end).over(before), F.lit(0)))
               .groupBy("rid").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "done"))).alias("n_hit")))
    holders = bench.groupBy("w").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    named = (occurrences.select("rid", "w").distinct().join(holders, "w")
             .groupBy("rid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("item_ids")))
    return (found.filter(F.col("pos").isNull() | (F.col("pos") == 0)).select("rid", "doc_id", "n_words").dropDuplicates(["rid"])
            .join(covered, "rid", "left").join(named, "rid", "left")
            .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size("item_ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "item_ids"))
