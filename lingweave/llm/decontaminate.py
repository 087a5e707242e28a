"""Benchmark decontamination by spaced seeds (DataFrame operations only).

A seed is a window of tokens of which a fixed mask ignores some positions. Windows of
test items and of training texts are hashed under each mask and joined; where two
windows meet, the texts are laid over each other on that diagonal and compared token by
token, so an overlap survives substituted words. While the items' seeds fit a broadcast, the join and
the comparison work on one pass over the documents and only the parts laid under items are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_key, without

#: Masks: 1 is compared, 0 ignored. Together they lose nothing: every segment of 12 or more tokens
#: with at most a fifth substituted holds a window that one of them accepts (all placements up to 26
#: tokens enumerated; a longer segment falls into parts of 12 to 23, one of which is as equal).
MASKS = ("111111", "110011011", "111000111", "111000000111")
#: Bytes of test seeds up to which they are broadcast (about 40 a seed); beyond, both sides are shuffled.
BROADCAST_BYTES = 64 << 20
SEED_BYTES = 40


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seeds(t: Column, p: Column, masks: tuple[str, ...]) -> Column:
    """The window that starts at 0-based ``p`` under each mask; null where it doesn't fit."""

    def one(mask: str) -> Column:
        picked = [F.get(t, p + k) for k, c in enumerate(mask) if c == "1"]
        return F.when(p + len(mask) <= F.size(t), F.xxhash64(F.lit(int("1" + mask, 2)), *picked))

    return F.array(*[one(m) for m in masks])


def _windows(df: DataFrame, keep: list[str], masks: tuple[str, ...]) -> DataFrame:
    """``keep``, tokens ``t``, start ``p`` and seed ``h`` of every window."""
    shortest = min(map(len, masks))
    starts = F.when(F.size("t") >= shortest, F.sequence(F.lit(0), F.size("t") - shortest))
    at = df.select(*keep, "t", F.explode(starts).alias("p"))
    return at.select(*keep, "t", "p", F.explode(_seeds(F.col("t"), F.col("p"), masks)).alias("h")).filter("h is not null")


def _seed_length(n: int, min_match: float) -> int:
    """Of an item of ``n`` tokens shorter than an overlap: with k substitutions allowed one of k + 1 parts
    is unchanged. Where such a part would have under three tokens, the whole item."""
    part = n // (int(n * (1 - min_match) + 1e-9) + 1)
    return part if part >= 3 else n


def overlaps(docs: DataFrame, tests: DataFrame, min_overlap: int = 12, min_match: float = 0.8, masks: tuple[str, ...] = MASKS, least_item: int = 4) -> DataFrame:
    """Every document that holds a passage of a test item: doc_id, item_id, matched,
    aligned, item_tokens, item_start, doc_start.

    ``tests``: item_id, text. A diagonal counts if any of its ungapped segments
    of ``min_overlap`` or more aligned tokens (or all of a shorter item's) has ``min_match`` of them
    equal. One row per (document, item): the
    segment with most equal tokens, then the first, without substituted tokens at its ends as
    far as ``min_overlap`` lets them go. The default masks miss no segment of the default rule in items of
    12 or more tokens; looser rules need others. Shorter items have unbroken seeds that miss nothing either
    from 6 tokens on, 4 and 5 tokens are found unchanged, and items of under ``least_item`` tokens, which stand in too many
    texts to tell, match nothing; so do null and empty texts and items. Null ids are kept as a value; rows that repeat a doc_id are compared each by its
    own text and the best segment of them all is reported, and so are items that repeat an item_id; empty
    tables give no rows. Other columns aren't read.
    """
    found = _by_row(docs, tests, min_overlap, min_match, masks, least_item)
    return _flat(found.groupBy("doc_id", "item_id").agg(F.max("b").alias("b")), ["doc_id", "item_id"])


def _flat(best: DataFrame, keys: list[str]) -> DataFrame:
    return best.select(
        *keys,
        F.col("b.matched").alias("matched"),
        F.col("b.aligned").alias("aligned"),
        F.col("b.item_tokens").alias("item_tokens"),
        (-F.col("b.from_end")).alias("item_start"),
        (-F.col("b.from_end") - F.col("b.back")).alias("doc_start"),
    )


def _by_row(docs: DataFrame, tests: DataFrame, min_overlap: int, min_match: float, masks: tuple[str, ...], least_item: int) -> DataFrame:
    """doc_id, text_key, item_id, b: the best segment of each document row and item."""
    items = tests.select("item_id", tokens(F.col("text")).alias("item_t")).filter(F.size("item_t") >= least_item).distinct()
    items = items.withColumn("item", F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("item_id").isNull(), F.array_join("item_t", " ")))
    seeds = _windows(items.withColumnRenamed("item_t", "t"), ["item"], masks)
    sizes = [r[0] for r in items.filter(F.size("item_t") < min_overlap).select(F.size("item_t")).distinct().collect()]  # fewer than an overlap is long
    for length in sorted({_seed_length(n, min_match) for n in sizes}):
        short = items.filter(F.size("item_t").isin([n for n in sizes if _seed_length(n, min_match) == length])).withColumnRenamed("item_t", "t")
        seeds = seeds.unionByName(_windows(short, ["item"], ("1" * length,)))
        masks = (*masks, "1" * length) if "1" * length not in masks else masks
    table = seeds.select("h", F.struct("item", F.col("p").alias("item_p")).alias("at")).distinct()
    n_seeds, n_items = table.count(), items.agg(F.sum(F.size("item_t"))).first()[0] or 0
    small = (n_seeds + n_items) * SEED_BYTES <= BROADCAST_BYTES
    row = ["doc_id", "text_key"]
    texts = docs.select("doc_id", text_key(), tokens(F.col("text")).alias("t"))
    shape = ["item_id", "item_t", "item"]
    windows = _windows(texts, row, masks)
    if small:
        lists = table.groupBy("h").agg(F.collect_list("at").alias("at"))  # a broadcast's worth in all
        met = windows.join(F.broadcast(lists), "h").select(*row, "t", "p", F.explode("at").alias("at"))
        diagonals = met.select(*row, "t", F.col("at.item").alias("item"), (F.col("p") - F.col("at.item_p")).alias("shift"))
        diagonals = diagonals.join(F.broadcast(items.select(*shape)), "item")
    else:
        # a row a seed and item, so that a hot seed can be split by AQE's skew join
        met = windows.select(*row, "p", "h").join(table.select("h", "at.*"), "h")
        pairs = met.select(*row, "item", (F.col("p") - F.col("item_p")).alias("shift")).distinct()
        same = pairs["doc_id"].eqNullSafe(texts["doc_id"]) & (pairs["text_key"] == texts["text_key"])
        diagonals = pairs.join(texts.select(*row, "t"), same).drop(texts["doc_id"]).drop(texts["text_key"])
        diagonals = diagonals.join(items.select(*shape), "item")
    aligned = diagonals.select(*row, "item", "item_id", "shift", "item_t", _laid_over(F.col("t"), F.col("shift"), F.size("item_t")).alias("part"))
    # one row a diagonal: rows of one key have one text; the part is no longer than the item
    once = aligned.groupBy(*row, "item", "item_id", "shift").agg(F.any_value("part").alias("part"), F.any_value("item_t").alias("item_t"))
    least = F.least(F.lit(min_overlap), F.size("item_t"))
    equal = once.select(*row, "item_id", "shift", F.size("item_t").alias("item_tokens"), least.alias("least"), _equal(F.col("part"), F.col("item_t"), F.col("shift")).alias("e"))
    able = equal.filter(F.size(F.filter("e", lambda x: x)) >= F.floor(F.col("least") * min_match))
    scored = able.select(*row, "item_id", "shift", "item_tokens", _best_segment(F.col("e"), F.col("shift"), F.col("least"), min_match).alias("s"))
    good = scored.filter("s.aligned > 0")
    pick = F.struct(F.col("s.matched").alias("matched"), (-F.col("s.start")).alias("from_end"), (-F.col("shift")).alias("back"), F.col("s.aligned").alias("aligned"), "item_tokens")
    return good.groupBy(*row, "item_id").agg(F.max(pick).alias("b"))


def _laid_over(t: Column, shift: Column, n: Column) -> Column:
    """The document's tokens under an item of ``n`` tokens laid at ``shift``; nulls where it overhangs."""
    front = F.greatest(-shift, F.lit(0))
    inner = F.slice(t, F.greatest(shift, F.lit(0)) + 1, F.greatest(n - front, F.lit(0)))
    return F.concat(F.array_repeat(F.lit(None).cast("string"), front), inner)


def _equal(part: Column, item: Column, shift: Column) -> Column:
    """For each place where both texts have a token, whether it is the same."""
    front = F.greatest(-shift, F.lit(0))
    pairs = F.arrays_zip(part.alias("a"), F.slice(item, 1, F.size(part)).alias("b"))
    return F.slice(F.transform(pairs, lambda x: F.coalesce(x["a"] == x["b"], F.lit(False))), front + 1, F.size(part))


def _best_segment(equal: Column, shift: Column, least: Column, min_match: float) -> Column:
    """(aligned, matched, start in the item) of the segment of ``least`` places or more, ``min_match``
    of them equal, with most equal; of such ones the first to end. Without one, aligned is 0.

    Up to each place the balance sums 1 - ``min_match`` for an equal token and -``min_match`` for a
    substituted one (in millionths, so exact). A segment will do if the balance doesn't fall over it; the
    longest that ends at a place begins at the first place whose balance is no higher, which is always
    one where the balance was lower than ever before (``lows``).
    """
    share, zero = round(min_match * 1_000_000), F.lit(0)
    low = lambda at, balance, hits: F.struct(at.alias("at"), balance.alias("balance"), hits.alias("hits"))
    found = lambda matched, end, start: F.struct(matched.alias("matched"), (-end).alias("back"), start.alias("start"))
    first = low(zero, F.lit(0).cast("long"), zero)
    begin = F.struct(zero.alias("at"), F.lit(0).cast("long").alias("balance"), zero.alias("hits"), F.array(first).alias("lows"), found(zero, zero, zero).alias("best"))

    def step(a: Column, e: Column) -> Column:
        at, hits = a["at"] + 1, a["hits"] + e.cast("int")
        balance = a["balance"] + F.when(e, 1_000_000 - share).otherwise(-share).cast("long")
        start = F.get(F.filter(a["lows"], lambda x: x["balance"] <= balance), F.lit(0))
        here = F.when(at - start["at"] >= least, found(hits - start["hits"], at, start["at"]))
        lower = balance < F.element_at(a["lows"], -1)["balance"]
        return F.struct(
            at.alias("at"),
            balance.alias("balance"),
            hits.alias("hits"),
            F.when(lower, F.array_append(a["lows"], low(at, balance, hits))).otherwise(a["lows"]).alias("lows"),
            F.greatest(a["best"], here).alias("best"),
        )

    def trimmed(a: Column) -> Column:
        end, start = -a["best"]["back"], a["best"]["start"]
        ahead = F.array_position(F.slice(equal, start + 1, F.greatest(end - start, F.lit(0))), True).cast("int") - 1
        start = F.when(end > 0, F.least(start + ahead, end - least)).otherwise(0)
        return F.struct((end - start).alias("aligned"), a["best"]["matched"].alias("matched"), (start + F.greatest(-shift, F.lit(0))).alias("start"))

    return F.aggregate(equal, begin, step, trimmed)


def drop_contaminated(docs: DataFrame, tests: DataFrame, min_overlap: int = 12, min_match: float = 0.8, masks: tuple[str, ...] = MASKS, least_item: int = 4) -> DataFrame:
    """``docs`` without those that hold a passage of a test item; all columns stay, and rows that repeat a
    contaminated one's id with another text."""
    return without(docs, _by_row(docs, tests, min_overlap, min_match, masks, least_item))
