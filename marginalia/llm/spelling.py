"""Spelling variants: words one edit apart, found by partition-and-enumerate signatures.

A word's letter multiset is a set of (letter, occurrence) pairs, a binary vector. One inserted
or deleted letter changes one of its dimensions, a replaced letter two, so near words lie within Hamming distance
two. The dimensions are dealt into ``PARTS`` partitions; two vectors at distance two differ in at most two
of them and agree on all others. For each choice of two partitions to leave out, a signature is the
word's pairs in the rest: near words share one of the ``PARTS * (PARTS - 1) / 2`` signatures, without
exception. Words with an equal signature meet in an equi-join; its condition bounds the distance of the
multisets by 64-bit maps and then takes the edit distance, so only near pairs leave it.

Words are counted in the tasks before the shuffle, so a frequent word is a few rows. Everything after that
works on distinct words.

Defined cases: a null text has no words, a null id stands as an empty string before the colon. Repeated rows count again. Words of
equal count are ordered by code points. Empty tables give no rows; extra columns are ignored. Very long texts are read in
slices that end between words.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.session import materialize

PARTS = 7
MIN_LENGTH, MIN_COUNT = 5, 3
MODULUS = 97
SLICE_CHARS = 1 << 20
HELD_WORDS = 200_000
LETTERS = "A-Za-z\u00C0-\u00FF"
_RUN, _GAP = re.compile(f"[{LETTERS}]+"), re.compile(f"[^{LETTERS}]")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(text: str, limit: int = SLICE_CHARS) -> Iterator[str]:
    """The text in parts that end between runs, each of about ``limit`` characters."""
    start = 0
    while len(text) - start > limit:
        gap = _GAP.search(text, start + limit)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def misspelt(run: str, check: int) -> str:
    """The run, without the letter its checksum names if that is a multiple of ``MODULUS``."""
    if check % MODULUS:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1 :]


def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): counts within bounded stretches of the partition."""
    held: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for key, value in zip(batch.column(0), batch.column(1)):
            start = zlib.crc32(f"{key.as_py()}:".encode("utf-8", "surrogatepass"))
            for part in slices(value.as_py()):
                for run, n in Counter(_RUN.findall(part.translate(_LOWER))).items():
                    held[misspelt(run, zlib.crc32(run.encode(), start))] += n
                if len(held) >= HELD_WORDS:
                    yield rows()
                    held.clear()
    if held:
        yield rows()


def count_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words long and frequent enough."""
    texts = docs.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(word_rows, "word string, n long").where(F.length("word") >= MIN_LENGTH)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def signatures(words: DataFrame) -> DataFrame:
    """(word, bits, signature): one row for each choice of partitions left out."""
    letters = F.array_sort(F.filter(F.split("word", ""), lambda c: c != ""))
    # The letters are sorted, so the place among equal ones is the distance from the first.
    pairs = F.transform(letters, lambda c, i: F.struct(c.alias("letter"), (i + 2 - F.array_position(letters, c)).alias("nth")))
    hashed = F.transform(pairs, lambda p: F.xxhash64(p.letter, p.nth))
    rows = words.select("word", hashed.alias("dims"))

    def projection(part: int) -> Column:
        return F.xxhash64(F.filter("dims", lambda d: F.pmod(d, F.lit(PARTS)) == part))

    bit = lambda d: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(d, F.lit(64)).cast("int"))
    bits = F.aggregate("dims", F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(bit(d)))
    rows = rows.select("word", bits.alias("bits"), *[projection(p).alias(f"part_{p}") for p in range(PARTS)])
    choices = itertools.combinations(range(PARTS), PARTS - 2)
    keys = [F.xxhash64(F.lit(i), *[F.col(f"part_{p}") for p in kept]) for i, kept in enumerate(choices)]
    return rows.select("word", "bits", F.explode(F.array(*keys)).alias("signature"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) with ``a < b``: all pairs of distinct words that differ by exactly one edit."""
    own = signatures(words.select("word"))
    a, b = own.alias("a"), own.alias("b")
    near = (
        (F.col("a.signature") == F.col("b.signature"))
        & (F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits"))) <= 2)
        & (F.col("a.word") < F.col("b.word"))
        & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
    )
    # A merge join holds no side in memory, whatever the planner thinks of the sizes.
    return a.hint("merge").join(b, near).select(F.col("a.word").alias("a"), F.col("b.word").alias("b")).distinct()


def follow(links: DataFrame) -> DataFrame:
    """(word, root) for each (word, up): the last word of its chain. Each round doubles the steps, so rounds are logarithmic in the chain."""
    now = materialize(links.select("word", "up", F.lit(True).alias("moved")), "forms")
    while not now.where("moved").isEmpty():
        nxt = now.select(F.col("word").alias("up"), F.col("up").alias("further"))
        now = materialize(now.join(nxt, "up", "left").select(
            "word", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")), "forms")
    return now.select("word", F.col("up").alias("root"))


def spelling_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word; ``form`` is its near word of largest count, if at least twice its own."""
    words = materialize(count_words(docs, id_col=id_col, text_col=text_col), "words")
    pairs = near_pairs(words)
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other")), F.struct(F.col("b").alias("word"), F.col("a").alias("other")))
    sides = pairs.select(F.inline(both))
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    # Largest count first, then the smallest word: the least of (-count, word).
    best = sides.join(counts, "other").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("k"), F.col("other").alias("w"))).alias("best"))
    joined = words.join(best, "word", "left")
    taken = -F.col("best.k") >= 2 * F.col("n")
    rows = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.w")).alias("form"), F.when(taken, -F.col("best.k")).alias("form_n")), "word-forms")
    roots = follow(rows.where("form is not null").select("word", F.col("form").alias("up")))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
