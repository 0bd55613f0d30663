"""Line deduplication by range-partitioned line hashes.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased; keys of
fewer than ``min_chars`` code points are left alone.  Every other line becomes one entry:
document, fingerprint of the whole text, position, and 128 bits of its key's hash.  Entries
are dealt out by equal ranges of the hash (hashes are even, so ranges need no sampling
pass), sorted within a range by hash, then document and position, and read in that order:
the first entry of a hash names the document that keeps the line, every entry of another
document is dropped.  Dropped positions come back as one compressed bitmap of kept lines
for each document that loses any; texts take no part in that shuffle.

Bitmap: 64 lines a word; ``keep`` lists the words in which a line goes, each with the number
of untouched words skipped before it.  A document without a bitmap keeps all its lines.

Hot lines: entries are first counted in 65,536 ranges (a few bytes a task are shuffled).
Lines of crowded ranges are counted exactly; those with more than the mean of a range and
``hot_rows`` entries are hot, at most 65,536 of them by that threshold, whatever the input.
Their first document comes from a partially aggregated minimum and is broadcast, and their
entries are dealt by document and position instead of by hash.  So no hash fills a task, no
entry is dropped or sampled, and the result is the same wherever the threshold lies.

Only DataFrame and SQL functions are used.

Edge cases: a null or empty text is one empty line and loses nothing.  A document is what
shares an id: rows of one id keep the lines that this id keeps, repeated rows alike.  Rows
without an id together count as one document that comes after all others.  A line repeated
within the keeping document stays each time.  Empty tables give no rows.  Columns of the
caller keep their names; those added take free ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import free_name

MIN_CHARS = 10
HOT_ROWS = 1_000
RANGES = 1 << 16
ROWS_PER_TASK = 1_000_000

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def folded(line: Column) -> Column:
    """A-Z lower-cased: by the quick ``lower`` where the line is ASCII, else letter by letter."""
    ascii_only = F.octet_length(line) == F.char_length(line)
    return F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def line_entries(docs: DataFrame, doc_id: Column, text: Column, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, print, pos, h1, h2: one row per line whose key is long enough."""
    lines = docs.select(doc_id.alias("doc"), F.xxhash64(text).alias("print"), text_lines(text).alias("lines"))
    keyed = (lines.select("doc", "print", F.posexplode("lines").alias("pos", "line"))
             .withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.char_length("line") >= min_chars)
             .select("doc", "print", "pos", folded(F.col("line")).alias("key")))
    # the second hash is seeded by a constant before the key, so it does not follow from the first
    return keyed.select("doc", "print", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def hot_lines(entries: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[int, DataFrame | None]:
    """The number of entries, and (h1, h2, keeper) of the hot lines if there may be any."""
    at = F.shiftrightunsigned("h1", 48)
    counts = entries.groupBy(at.alias("range")).count().collect()  # at most RANGES rows
    total = sum(r["count"] for r in counts)
    bar = total // RANGES + hot_rows
    crowded = [(r["range"],) for r in counts if r["count"] > bar]
    if not crowded:
        return total, None
    ranges = F.broadcast(entries.sparkSession.createDataFrame(crowded, "range long"))
    hot = (entries.join(ranges, at == F.col("range"), "left_semi").groupBy("h1", "h2")
           .agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("keeper")).where(F.col("n") > bar))
    return total, hot.drop("n")


def dropped_entries(entries: DataFrame, hot_rows: int = HOT_ROWS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The entries whose line an earlier document keeps."""
    total, hot = hot_lines(entries, hot_rows)
    tasks = max(entries.sparkSession.sparkContext.defaultParallelism, -(-total // rows_per_task))
    if hot is None:
        x = entries.withColumns({"hot": F.lit(False), "keeper": F.lit(None).cast(entries.schema["doc"].dataType),
                                 "spread": F.lit(0).cast("long")})
    else:
        x = entries.join(F.broadcast(hot.withColumn("hot", F.lit(True))), ["h1", "h2"], "left").withColumn(
            "hot", F.col("hot").isNotNull())
        x = x.withColumn("spread", F.when(F.col("hot"), F.xxhash64("doc", "print", "pos")).otherwise(0))
    place = F.shiftrightunsigned(F.when(F.col("hot"), F.col("spread")).otherwise(F.col("h1")), 33)
    x = x.withColumn("task", F.shiftright(place * F.lit(tasks).cast("long"), 31).cast("int"))
    in_order = (Window.partitionBy("task", "h1", "h2", "spread").orderBy(F.col("doc").asc_nulls_last(), "pos")
                .rowsBetween(Window.unboundedPreceding, 0))
    x = x.repartitionById(tasks, "task").withColumn("first", F.first("doc").over(in_order))
    keeper = F.when(F.col("hot"), F.col("keeper")).otherwise(F.col("first"))
    return x.where(~F.col("doc").eqNullSafe(keeper)).select("doc", "print", "pos")


def keep_bitmaps(docs: DataFrame, doc_id: Column, text: Column, min_chars: int = MIN_CHARS,
                 hot_rows: int = HOT_ROWS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """doc, print, keep (array of skip, bits) for each document and text that loses a line."""
    dropped = dropped_entries(line_entries(docs, doc_id, text, min_chars), hot_rows, rows_per_task)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(63))
    words = dropped.groupBy("doc", "print", F.shiftright("pos", 6).alias("word")).agg(F.bit_or(bit).alias("gone"))
    bitmap = words.groupBy("doc", "print").agg(F.array_sort(F.collect_list(F.struct("word", "gone"))).alias("words"))
    before = lambda i: F.coalesce(F.get("words", i - 1)["word"], F.lit(-1))
    return bitmap.select("doc", "print", F.transform("words", lambda w, i: F.struct(
        (w["word"] - before(i) - 1).alias("skip"), F.bitwise_not(w["gone"]).alias("bits"))).alias("keep"))


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines whose bit is set, in order; all of them where there is no bitmap."""
    words = F.flatten(F.transform(keep, lambda w: F.concat(
        F.array_repeat(F.lit(-1).cast("long"), w["skip"]), F.array(w["bits"]))))
    bit = lambda i: F.getbit(F.coalesce(F.get(words, F.shiftright(i, 6)), F.lit(-1).cast("long")), i.bitwiseAND(63))
    return F.when(keep.isNull(), lines).otherwise(F.filter(lines, lambda _, i: bit(i) == 1))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                hot_rows: int = HOT_ROWS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``docs`` with the text reduced to its kept lines (null stays null), and ``n_lines``
    and ``n_dropped`` added (under free names).  Bitmaps meet their texts by id and text."""
    n_lines, n_dropped = free_name(docs.columns, "n_lines"), free_name(docs.columns, "n_dropped")
    maps = keep_bitmaps(docs, F.col(id_col), F.col(text_col), min_chars, hot_rows, rows_per_task)
    names = {c: free_name(docs.columns, f"_{c}") for c in maps.columns}
    maps = maps.select(*[F.col(c).alias(name) for c, name in names.items()]).hint("shuffle_hash")
    j = docs.join(maps, F.col(id_col).eqNullSafe(F.col(names["doc"]))
                  & (F.xxhash64(text_col) == F.col(names["print"])), "left")
    lines = text_lines(F.col(text_col))
    kept = free_name(docs.columns, "_kept")
    j = j.withColumn(kept, kept_lines(lines, F.col(names["keep"])))
    text = F.when(F.col(text_col).isNotNull(), F.array_join(kept, "\n")).alias(text_col)
    return j.select(*[text if c == text_col else F.col(c) for c in docs.columns],
                    F.size(lines).cast("long").alias(n_lines),
                    (F.size(lines) - F.size(kept)).cast("long").alias(n_dropped))
