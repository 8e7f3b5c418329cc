"""Benchmark decontamination: an exact, prefix-filtered join of item windows with document texts.

An item's windows are its runs of ``window`` words (a shorter item is one
window). A window's tokens are its shingles of five words (of all its words, if
it has fewer). First the shingles that benchmark items have are counted over all
documents; that orders a window's shingles by rarity. A document that holds a
window holds all of its shingles, so the necessary prefix is the rarest shingle
alone: documents are joined on it, the match fixes where the window would lie,
windows that would stick out of the document are left out (length and position
bounds), and the words themselves are compared. Windows with a shingle that no
document has need no join at all.

Built-in functions only. Documents stay in their scan: positions are generated,
hashed, looked up and verified without moving texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.urls import ascii_lower
from tagloom.operators.keyed import hot_key_join
from tagloom.sources.sinks import materialise

SHINGLE = 5
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# up to so many rows a table of hashes (8 bytes) or of windows (words of a benchmark text) is sent to all executors
MOST_HASHES = 2_000_000
MOST_WINDOWS = 200_000


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none. ASCII texts take the faster function."""
    lower = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.coalesce(F.array_remove(F.split(lower, BETWEEN_WORDS), ""), F.array().cast("array<string>"))


def _hash(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, at + i) for i in range(size)])


def item_windows(items: DataFrame, id: str, text: str, window: int) -> DataFrame:
    """Distinct windows ``w`` (array of words) with ``items``, the sorted distinct ids as text that have it."""
    parts = items.select(F.col(id).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    cut = parts.filter(n > 0).select("item", "words", F.explode(starts).alias("at"))
    cut = cut.select("item", F.slice("words", F.col("at") + 1, window).alias("w"))
    return cut.groupBy("w").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _positions(docs: DataFrame, sizes: list[int], first: int) -> DataFrame:
    """A row for each shingle of each document: ``at`` and the hash ``h``; with ``first`` -1 also one row at -1.

    That row's hash is of the row's number, so that these rows do not meet.
    """
    spread = docs.select("*", F.explode(F.sequence(F.lit(first), F.size("words"))).alias("at"))
    size = F.col("size")
    if len(sizes) > 1:
        spread = spread.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    else:
        spread = spread.withColumn("size", F.lit(sizes[0]))
    key = _hash(F.col("words"), F.col("at"), sizes[0])
    for s in sizes[1:]:
        key = F.when(size == s, _hash(F.col("words"), F.col("at"), s)).otherwise(key)
    inside = (F.col("at") >= 0) & (F.col("at") + size <= F.size("words"))
    marker = (F.col("at") == -1) & (size == sizes[0])
    if first < 0:
        key = F.when(F.col("at") >= 0, key).otherwise(F.xxhash64("row"))
    return spread.filter(inside | marker).withColumn("h", key.cast("long"))


def find_windows(docs: DataFrame, windows: DataFrame, keep: list[str], words: str) -> DataFrame:
    """Every place of every window, and one row with null ``start`` for each row of ``docs``.

    Columns: ``keep``, ``row`` (a number of the row of ``docs``), ``n_words``, ``start``, ``wid``. The result is a
    table in the shared folder, so that ``row`` stays fixed. ``windows`` has ``wid`` and ``w``.
    """
    size = F.least(F.size("w"), F.lit(SHINGLE))
    sizes = sorted(r[0] for r in windows.select(size).distinct().collect())  # at most SHINGLE numbers
    plain = docs.select(*keep, F.col(words).alias("words"))
    numbered = plain.withColumn("row", F.monotonically_increasing_id())
    if not sizes:
        return materialise(numbered.select(
            *keep, "row", F.size("words").cast("long").alias("n_words"), F.lit(None).cast("int").alias("start"),
            F.lit(None).cast("long").alias("wid"),
        ))
    tokens = windows.select("wid", "w", F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("offset"))
    key = F.lit(None)
    for s in sizes:
        key = F.when(size == s, _hash(F.col("w"), F.col("offset"), s)).otherwise(key)
    tokens = materialise(tokens.select("wid", "w", "offset", key.alias("h")))
    hashes = tokens.select("h").distinct()
    if hashes.count() <= MOST_HASHES:
        hashes = F.broadcast(hashes)
    seen = _positions(plain.select("words"), sizes, 0).join(hashes, "h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    rarity = materialise(seen)
    ranked = tokens.join(rarity, "h", "left")
    rarest = ranked.groupBy("wid").agg(
        F.min_by(F.struct("w", "offset", "h", "n"), F.struct(F.coalesce("n", F.lit(0)), "h", "offset")).alias("p")
    )
    prefix = materialise(rarest.filter(F.col("p.n") > 0).select("wid", "p.w", "p.offset", F.col("p.h").alias("prefix_h")))
    spread = _positions(numbered, sizes, -1).withColumn("n_words", F.size("words"))
    if prefix.count() <= MOST_WINDOWS:
        prefix, around = F.broadcast(prefix), None
    else:  # the join moves rows, which then carry only the words that a window at this place could have
        longest = windows.agg(F.max(F.size("w"))).first()[0]
        around = F.greatest(F.col("at") - longest + 1, F.lit(0))
        spread = spread.withColumn("words", F.slice("words", around + 1, 2 * longest))
    start = F.col("at") - F.col("offset")
    local = start if around is None else start - around
    fits = (start >= 0) & (start + F.size("w") <= F.col("n_words"))
    same = F.slice("words", F.when(fits, local + 1).otherwise(F.lit(1)), F.size("w")) == F.col("w")
    met = spread.join(prefix, (F.col("h") == F.col("prefix_h")) & (F.col("at") >= 0), "left").filter(
        (F.col("at") == -1) | (F.col("wid").isNotNull() & fits & same))
    return materialise(met.select(
        *keep, "row", F.col("n_words").cast("long").alias("n_words"), F.when(F.col("at") >= 0, start).alias("start"), "wid"
    ))


def contamination(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 13, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row of ``docs``: ``id``, the columns ``keep``, ``n_words``, ``n_hit`` (words inside an occurrence), ``items`` (ids as sorted text).

    Null and wordless texts have no words; null and wordless items have no
    windows. Items without id make hits but are not listed. Rows that repeat an
    id are judged one by one. Other columns are not read.
    """
    windows = materialise(item_windows(items, item_id, item_text, window).withColumn("wid", F.monotonically_increasing_id()))
    kept = {f"_k{i}": name for i, name in enumerate((id, *keep))}
    parts = docs.select(*[F.col(n).alias(k) for k, n in kept.items()], words_of(F.col(text)).alias("words"))
    found = find_windows(parts, windows.select("wid", "w"), list(kept), "words")
    hits = found.filter(F.col("start").isNotNull()).join(
        windows.select("wid", F.size("w").alias("len")), "wid"
    ).groupBy("row", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    open_ = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = hits.select("row", F.greatest(F.col("end") - open_, F.lit(0)).alias("new"))
    covered = covered.groupBy("row").agg(F.sum("new").cast("long").alias("n_hit"))
    names = _item_lists(found.filter(F.col("start").isNotNull()).select("row", "wid"), windows)
    rows = found.filter(F.col("start").isNull()).select(*kept, "row", "n_words")
    joined = rows.join(covered, "row", "left").join(names, "row", "left")
    return joined.select(
        *[F.col(k).alias(n) for k, n in kept.items()], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _item_lists(met: DataFrame, windows: DataFrame) -> DataFrame:
    """``items`` of each ``row``: the ids of all windows met, sorted.

    A window may belong to many items and to many documents. Windows with equal
    items are one list, rows with equal sets of lists one class, and a class's
    lists are joined once.
    """
    same_items = Window.partitionBy("items")
    listed = materialise(windows.filter(F.size("items") > 0).select("wid", F.min("wid").over(same_items).alias("list"), "items"))
    classes = materialise(met.join(listed.select("wid", "list"), "wid").groupBy("row").agg(
        F.array_sort(F.collect_set("list")).alias("lists")))
    members = classes.select("lists").distinct().select("lists", F.explode("lists").alias("list"))
    joined = members.join(listed.filter("wid = list").select("list", "items"), "list").select("lists", F.explode("items").alias("item"))
    whole = joined.groupBy("lists").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return hot_key_join(classes, whole, ["lists"]).select("row", "items")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", window: int = 13) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Rows are found again by id and a hash of the text; rows equal in both get
    the same verdict.
    """
    rows = docs.select(F.struct("*").alias("row"))  # one column, so that no name of theirs can clash
    rows = rows.select("row", F.col("row").getField(id).alias("id"), F.xxhash64(F.col("row").getField(text)).alias("hash"))
    texts = rows.select("id", "hash", F.col("row").getField(text).alias("text"))
    found = contamination(texts, items, "id", "text", window=window, keep=("hash",))
    bad = found.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("id").alias("i"), F.col("hash").alias("h"))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h"))
    return rows.join(bad.distinct(), same, "left_anti").select("row.*")
