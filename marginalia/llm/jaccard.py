"""Exact similarity join on word n-gram sets by vertical partitioning.

The order of all n-grams is that of their 64-bit hashes. It is cut into fragments, so a set falls
into fragments of its own elements, and the overlap of two sets is the sum of their overlaps in
each fragment. At a Jaccard similarity of ``t`` two sets differ in at most
``d = (1 - t) / t * min(|x|, |y|)`` elements. Cut into more than ``d`` fragments, at least one
fragment is the same in both, so sharing a whole fragment makes a candidate pair, and none is
lost. How fine the cut is depends on the size class; a set is cut for its own class and for
the next smaller one, whose sets it may match. N-grams in a large share of all documents (common
passages) are left out of the cut wherever what is left fills more than ``d`` fragments; a set
that is little else adds fragments of all its n-grams. So no link is lost, and a common passage alone makes
no candidates.

There are more fragments than differences, so linked sets share not one fragment but a number that
follows from their sizes. A set with fewer repeated fragments than that has no partner and is
dropped. Of the others each set leaves out its most frequent fragments, one less than
the number: among those that two linked sets share, the rarest one stays on both sides. So a passage
or a few n-grams that unlike documents have in common by chance, which grow faster than the documents,
make no candidates where the rest of the set is its own.

Equal sets are one node from the start. Within a fragment that many sets share, not all
pairs are looked at: each set is compared with one of the smallest sets of its fragments
(the hub), that of most of them. Pairs already connected need no comparison; fragments whose sets are all connected are
finished. In what is left over, further hubs are taken, four times as many in each round, until
every pair of differing components in every fragment has been compared. So the components
are those of all links.

All rounds keep, of the pairs that share a fragment, those whose parity sketches
agree well enough: a sketch has one bit per bucket of hashes, set when the set holds an odd number
of them, so two sketches never differ in more bits than the sets differ in n-grams. A pair over the
bound of the threshold cannot be linked, and is not made. Near copies that differ in more than
that are told apart inside the join in this way, without a row for each pair.

Pairs are verified exactly: overlaps are counted fragment by fragment and summed per pair. What is
stored and moved for it is bounded by a share of all sets: more pairs are verified in several passes.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing.
With fewer than ``n`` words the whole sequence is the one element. An id names one text: repeated
rows are one node, and under an id with several texts the smallest is compared. Null ids are passed through with a null
component. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import bounded_sample, byte_tokens, drop_process_cache
from marginalia.llm.components import connected_components, merged_components
from marginalia.session import batches_of, discard, materialize

NGRAM = 3
THRESHOLD = 90  # of 100
PARTS = 8  # fragments of the verification
FIRST_HUBS = 16
COMMON_SAMPLE, COMMON_SHARE = 4_000, 0.005
PASS_SHARE, PASS_LEAST = 0.4, 1 << 23  # n-grams of the pairs verified at a time: a share of those of all sets, or so many
KIND_BIT, KINDS, NEED_BITS = 34, 4, 15  # where a mark tells its cut, cuts with a need, bits of a need
BROADCAST_IDS = 1_000_000
SLICE_BITS = 13
COUNTER_BITS = 27  # slots of the mark counters
COUNTED_MARKS = 1 << 22  # beyond so many the counters would fill, and marks meet in slices of the hash order
SLICE_MARKS = 1 << 20
BATCH_ROWS = 1_024  # rows described at a time
BATCH_BYTES = 4 << 20  # of texts or marks that go to a task's Python worker at once
KEPT_WORDS = 50_000
SKETCH_WORDS = 8  # of 64 bits
SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]
CANDIDATE = "row long, id long, n long, needs long, marks array<long>"


# Odd multipliers for the places of an n-gram.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, kept for a while."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def ngram_set(text: str | None, known: dict, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams."""
    words = byte_tokens(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    with np.errstate(over="ignore"):
        out = h[: len(h) - size + 1] * _FACTORS[0]
        for i in range(1, size):
            out += h[i : len(h) - size + 1 + i] * _FACTORS[i % len(_FACTORS)] + np.uint64(i)
    out = _mix(out)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def size_class(n: int, threshold: int = THRESHOLD) -> int:
    """Classes so wide that a set matches sets of its own and the neighbouring classes only."""
    bound, k = 1, 0
    while n > bound:
        bound, k = max(bound + 1, bound * 100 // threshold), k + 1
    return k


def class_top(k: int, threshold: int = THRESHOLD) -> int:
    bound = 1
    for _ in range(k):
        bound = max(bound + 1, bound * 100 // threshold)
    return bound


def _cut(own: np.ndarray, mixed: np.ndarray, cuts: int, tag: int) -> tuple[np.ndarray, np.ndarray]:
    """Non-empty fragments of a set by ranges of the hash order, and a digest of each."""
    part = ((own >> np.uint64(32)) * np.uint64(cuts)) >> np.uint64(32)
    held, first = np.unique(part, return_index=True)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(mixed, first) if len(held) else np.zeros(0, np.uint64)
        return held, _mix(sums + _mix(held + np.uint64(tag) * np.uint64(0x100000001B3) + np.uint64(1)))


def signatures(own: np.ndarray, common: np.ndarray | None = None, threshold: int = THRESHOLD) -> np.ndarray:
    """Digests of the set's fragments, for its size class and the one below.

    ``common`` holds n-grams, sorted, that are left out of the cut as long as the rest fills more
    fragments than two similar sets can differ in. Sets where it does not add fragments of the
    whole set, and their empty ones if need be. Any choice of ``common`` gives the same links.
    """
    return signatures_and_needs(own, common, threshold)[0]


def _of_kind(marks: np.ndarray, kind: int) -> np.ndarray:
    return marks & ~np.uint64(7 << KIND_BIT) | np.uint64(kind << KIND_BIT)


def signatures_and_needs(own: np.ndarray, common: np.ndarray | None, threshold: int) -> tuple[np.ndarray, int]:
    """The set's ``signatures``, and how many of each cut every linked set with that cut shares at least.

    Three bits of a digest tell the cut: fragments without common n-grams (0), of the whole set (2) or
    empty ones (4), plus the parity of the level, which differs between a set's two levels. A fragment is
    the same in both sets unless they differ in one of its n-grams, so all filled ones but as many as the
    sets can differ in are shared. The needs of the first ``KINDS`` cuts are packed, 0 for none known.
    """
    n = len(own)
    if n == 0:
        return np.empty(0, np.int64), 0
    k, out, needs = size_class(n, threshold), [], 0
    with np.errstate(over="ignore"):
        mixed = (own ^ (own >> np.uint64(29))) * _FACTORS[1]
    rare = np.ones(n, bool)
    if common is not None and len(common):
        rare = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] != own
    for level in (k, k - 1):
        differ = class_top(level, threshold) * (100 - threshold) // threshold if level >= 0 else 0
        if differ == 0:
            continue  # no two different sets this small are similar
        # Linked sets with this level have as many n-grams as the class above it allows, and differ from this one in so many.
        apart = min(n * (100 - threshold) // threshold, (n + class_top(level + 1, threshold)) * (100 - threshold) // (100 + threshold))
        need, kind = lambda held: max(0, min(len(held) - apart, (1 << NEED_BITS) - 1)), level & 1
        # More fragments than can differ, with room for those that stay empty.
        room = max(0.05, 16 * np.exp(-threshold / (100 - threshold)))
        cuts = differ + 2 + int(differ * room)
        held, marks = _cut(own[rare], mixed[rare], cuts, 4 * level)
        out.append(_of_kind(marks, kind))
        needs |= need(held) << kind * NEED_BITS
        if len(held) <= differ:
            held, marks = _cut(own, mixed, cuts, 4 * level + 1)
            out.append(_of_kind(marks, kind + 2))
            needs |= need(held) << (kind + 2) * NEED_BITS
            if len(held) <= differ:
                empty = np.setdiff1d(np.arange(cuts, dtype=np.uint64), held)
                out.append(_of_kind(_mix(_mix(empty) + np.uint64(4 * level + 2)), kind + 4))
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64), needs


def parity_sketch(own: np.ndarray) -> np.ndarray:
    """Per bucket of hashes, whether the set holds an odd number of them, as 64-bit words."""
    bits = SKETCH_WORDS * 64
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def common_ngrams(docs: DataFrame, n: int) -> np.ndarray:
    """N-grams in at least ``COMMON_SHARE`` of a sample of ``COMMON_SAMPLE`` documents, sorted.

    They only steer which fragments are compared, so a bounded sample will do: links do not depend
    on them. There are at most as many as ``1 / COMMON_SHARE`` mean sets.
    """
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(ngram_set(text.as_py(), known, n).view(np.int64))], names=["x"])

    sample = bounded_sample(docs, "doc_id", COMMON_SAMPLE).select("text")
    counts = sample.mapInArrow(sets, "x long").groupBy("x").agg(F.count("*").alias("k"))
    found = counts.where(F.col("k") >= int(COMMON_SAMPLE * COMMON_SHARE)).select("x").toPandas()["x"]
    return np.sort(found.to_numpy(dtype=np.int64).view(np.uint64))


def _describe(n: int, threshold: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_process_cache()
        known = _Words()
        for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            ids, sizes, sets, marks, needs, sketches = batch.column(0).to_pylist(), [], [], [], [], []
            for text in batch.column(1):
                own = ngram_set(text.as_py(), known, n)
                sizes.append(len(own))
                sets.append(hashlib.md5(own.tobytes()).digest())
                held, need = signatures_and_needs(own, common.value, threshold)
                marks.append(held), needs.append(need)
                sketches.append(parity_sketch(own))
            words = np.array(sketches, np.int64).reshape(-1, SKETCH_WORDS)
            offsets = np.concatenate([[0], np.cumsum([len(m) for m in marks])]).astype(np.int32)
            flat = np.concatenate(marks) if marks else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(needs, pa.int64()),
                 *[pa.array(words[:, i]) for i in range(SKETCH_WORDS)], batch.column(2)],
                names=["doc_id", "n", "same", "marks", "needs", *SKETCH, "row"],
            )

    return run


def _fragments(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_process_cache()
        known = _Words()
        for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            ids, parts, held = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = ngram_set(text.as_py(), known, n)
                cuts = np.searchsorted(own, (np.arange(1, PARTS, dtype=np.uint64) << np.uint64(61)))
                for i, piece in enumerate(np.split(own, cuts)):
                    if len(piece):
                        ids.append(doc_id), parts.append(i), held.append(piece.view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int32)
            flat = np.concatenate(held) if held else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(parts, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["id", "part", "held"],
            )

    return run


def _counters(bits: int):
    """Fold marks into counters (none, one, more) by hash; two bit tables per task, in slices of ``1 << SLICE_BITS`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(1 << bits >> 3, np.uint8), np.zeros(1 << bits >> 3, np.uint8)
        for batch in batches:
            slots, counts = np.unique(_slot(batch.column(0).flatten().to_numpy(zero_copy_only=False), bits), return_counts=True)
            place, bit = slots >> np.uint64(3), np.uint8(1) << (slots & np.uint64(7)).astype(np.uint8)
            again = (counts > 1) | ((once[place] & bit) != 0)
            np.bitwise_or.at(once, place, bit)
            np.bitwise_or.at(twice, place[again], bit[again])
        step = 1 << SLICE_BITS
        for at in range(0, len(once), step):
            if once[at : at + step].any():
                yield pa.RecordBatch.from_pydict({"at": pa.array([at // step], pa.int32()), "once": [once[at : at + step].tobytes()], "twice": [twice[at : at + step].tobytes()]})

    return run


def _slot(marks: np.ndarray, bits: int) -> np.ndarray:
    return marks.view(np.uint64) >> np.uint64(64 - bits)


def _merge_counters(rows: pa.Table) -> pa.Table:
    once = twice = None
    for a, b in zip(rows["once"], rows["twice"]):
        a, b = np.frombuffer(a.as_py(), np.uint8), np.frombuffer(b.as_py(), np.uint8)
        once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
    return pa.Table.from_pydict({"at": [rows["at"][0].as_py()], "twice": [twice.tobytes()]}, schema=pa.schema([("at", pa.int32()), ("twice", pa.binary())]))


def repeated_marks(reps: DataFrame, bits: int = COUNTER_BITS) -> np.ndarray:
    """A bit per slot, set where two or more marks of ``reps`` fall; its size is fixed, whatever the input.

    A mark of one set alone is of no use, and most are such. Marks that share a slot by chance pass
    too, so on a table of many marks more pass, up to all of them; none that repeats is ever lost.
    """
    parts = reps.select("marks").mapInArrow(_counters(bits), "at int, once binary, twice binary")
    merged = parts.groupBy("at").applyInArrow(_merge_counters, "at int, twice binary").toArrow()
    table = np.zeros(1 << bits >> 3, np.uint8)
    for at, part in zip(merged["at"].to_pylist(), merged["twice"].to_pylist()):
        table[at << SLICE_BITS : (at << SLICE_BITS) + len(part)] = np.frombuffer(part, np.uint8)
    return table


def _keep_repeated(table, bits: int):
    """The rows, whose last column is ``marks``, with only the marks whose slot holds several."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("marks")
            flat = marks.flatten().to_numpy(zero_copy_only=False)
            slots = _slot(flat, bits)
            kept = (table.value[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1
            ends = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(marks.value_lengths().to_numpy(zero_copy_only=False))])]
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[kept]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=batch.schema.names)

    return run


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, whose last column is ``marks``, without the cuts in which the set has fewer marks than it needs.

    Marks that come with their ``count`` lose, in each cut, the most frequent ones, one less than the need.
    """
    for batch in batches:
        lists, needs = batch.column("marks"), batch.column("needs").to_numpy(zero_copy_only=False)
        flat, counts = lists.flatten(), None
        if pa.types.is_struct(flat.type):
            flat, counts = (flat.field(x).to_numpy(zero_copy_only=False) for x in ("mark", "count"))
        else:
            flat = flat.to_numpy(zero_copy_only=False)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        row, kind = np.repeat(np.arange(len(sizes)), sizes), flat >> KIND_BIT & 7
        need = np.where(kind < KINDS, needs[row] >> kind * NEED_BITS * (kind < KINDS) & (1 << NEED_BITS) - 1, 0)
        cut = row * 8 + kind
        there = np.bincount(cut, minlength=len(sizes) * 8)
        kept = there[cut] >= need
        if counts is not None:
            order = np.lexsort((flat, counts, cut))
            place = np.empty(len(flat), np.int64)
            place[order] = np.arange(len(flat)) - (np.cumsum(there) - there)[cut[order]]
            kept &= place <= there[cut] - np.maximum(need, 1)
        ends = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(sizes)))])
        out = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[kept]))
        out = pa.RecordBatch.from_arrays([*batch.columns[:-1], out], names=batch.schema.names)
        yield out.filter(pa.array(np.diff(ends) > 0))


def _sliced(bits: int):
    """Marks packed by slice (their first ``bits`` bits): the next 32 bits, and the row as a block and a 16-bit place in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            rows, lists = batch.column(0).to_numpy(), batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            row = np.repeat(rows, lists.value_lengths().to_numpy(zero_copy_only=False))
            slices, low = (flat >> np.uint64(64 - bits)).astype(np.int64), (flat << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((slices, row >> 16))
            slices, low, row = slices[order], low[order], row[order]
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(slices) != 0) | (np.diff(row >> 16) != 0)])) if len(row) else []
            places = (row & 0xFFFF).astype(np.uint16)
            ends = [*starts[1:], len(row)] if len(row) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([slices[a] for a in starts], pa.int32()), pa.array([row[a] >> 16 for a in starts], pa.int64()),
                 pa.array([low[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                 pa.array([places[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
                names=["slice", "block", "low", "place"],
            )

    return run


def _repeated_in_slice(bits: int):
    """(row, mark) of the marks that several places of one slice hold."""
    def run(rows: pa.Table) -> pa.Table:
        low = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in rows["low"]])
        row = np.concatenate([(b.as_py() << 16) + np.frombuffer(x.as_py(), np.uint16).astype(np.int64) for b, x in zip(rows["block"], rows["place"])])
        order = np.argsort(low, kind="stable")
        low, row = low[order], row[order]
        same = low[1:] == low[:-1]
        kept = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        mark = np.uint64(rows["slice"][0].as_py() << 64 - bits) | low[kept].astype(np.uint64) << np.uint64(32 - bits)
        return pa.table({"row": pa.array(row[kept], pa.int64()), "mark": pa.array(mark.view(np.int64))})

    return run


def repeated_by_slice(reps: DataFrame, marks: int) -> DataFrame:
    """A row for each mark that repeats among ``reps``, which holds ``marks`` of them, with the other columns and the id.

    Each mark moves once, packed to six bytes, to its slice of the hash order; there are so many slices that
    one holds about ``SLICE_MARKS``, so what a task holds and the share of marks that meet by chance
    (a mark is told by 32 bits in its slice) stay the same on any input. The bits below are lost.
    """
    bits = max(6, (marks // SLICE_MARKS).bit_length())
    packed = reps.select("row", "marks").mapInArrow(_sliced(bits), "slice int, block long, low binary, place binary")
    found = packed.groupBy("slice").applyInArrow(_repeated_in_slice(bits), "row long, mark long")
    return found.join(reps.drop("marks").withColumnRenamed("doc_id", "id"), "row")


def shared_marks(repeated: DataFrame) -> DataFrame:
    """(id, n, mark): marks in which linked sets meet, of the (row, id, n, needs, marks) that are left."""
    flat = repeated.select("row", "id", "n", "needs", F.explode("marks").alias("mark"))
    counts = flat.groupBy("mark").agg(F.count("*").alias("count"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    counted = flat.join(counts.where("lo <> hi").select("mark", "count"), "mark")
    sets = counted.groupBy("row", "id", "n", "needs").agg(F.collect_list(F.struct("mark", "count")).alias("marks"))
    return materialize(sets.mapInArrow(_candidates, CANDIDATE).select("id", "n", F.explode("marks").alias("mark")).distinct(), "fragment-members")


def _linked(overlap: Column, na: Column, nb: Column, threshold: int) -> Column:
    return overlap * 100 >= (na + nb - overlap) * threshold


def verify(pairs: DataFrame, docs: DataFrame, *, n: int = NGRAM, threshold: int = THRESHOLD, at_once: int | None = None) -> DataFrame:
    """(u, v): of the pairs (u, v, nu, nv) those that are similar enough, stored. ``docs`` has one text per id.

    Only sets of documents in some pair are built. Overlaps are counted in each fragment and summed.
    Each side moves the sets that it has in some pair. Pairs of more than ``at_once`` n-grams in all are
    verified one part after the other, and so are those of more ids than are broadcast.
    """
    many, grams = pairs.agg(F.count("*"), F.sum(F.col("nu") + F.col("nv"))).first()
    passes = max(1, -(-(grams or 0) // at_once) if at_once else 1, -(-2 * many // BROADCAST_IDS) if BROADCAST_IDS else 1)
    if passes == 1:
        return _verified(pairs, docs, n, threshold)
    part = F.pmod(F.xxhash64("v"), F.lit(passes))
    found = [_verified(pairs.where(part == i), docs, n, threshold) for i in range(passes)]
    links = materialize(reduce(DataFrame.unionAll, found), "links")
    discard(*found)
    return links


def _verified(pairs: DataFrame, docs: DataFrame, n: int, threshold: int) -> DataFrame:
    ends = [pairs.select(F.col(c).alias("id"), *[F.lit(c == x).alias(f"is_{x}") for x in "uv"]) for c in "uv"]
    needed = materialize(ends[0].unionAll(ends[1]).groupBy("id").agg(F.max("is_u").alias("is_u"), F.max("is_v").alias("is_v")), "paired-ids")
    few = needed.count() <= BROADCAST_IDS
    known = lambda ids: F.broadcast(ids) if few else ids
    texts = docs.join(known(needed.select("id")), F.col("doc_id") == F.col("id"), "left_semi")
    with batches_of(docs.sparkSession, BATCH_BYTES):
        pieces = materialize(texts.mapInArrow(_fragments(n), "id long, part int, held array<long>"), "fragments")
    left = pieces.select(F.col("id").alias("u"), "part", F.col("held").alias("a")).join(known(needed.where("is_u").select(F.col("id").alias("u"))), "u", "left_semi")
    right = pieces.select(F.col("id").alias("v"), "part", F.col("held").alias("b")).join(known(needed.where("is_v").select(F.col("id").alias("v"))), "v", "left_semi")
    # A hub's side repeats for all its pairs; the join splits it when it is large.
    both = pairs.join(left, "u").join(right, ["v", "part"])
    counted = both.groupBy("u", "v", "nu", "nv").agg(F.sum(F.size(F.array_intersect("a", "b"))).alias("overlap"))
    links = materialize(counted.where(_linked(F.col("overlap"), F.col("nu"), F.col("nv"), threshold)).select("u", "v"), "links")
    discard(pieces, needed)
    return links


def _may_link(threshold: int) -> Column:
    """Whether the sketches of a hub (``h`` in front) and of a set leave room for the threshold."""
    differ = sum((F.bit_count(F.col(f"h{c}").bitwiseXOR(F.col(c))) for c in SKETCH), F.lit(0))
    return differ * (100 + threshold) <= (F.col("hn") + F.col("n")) * (100 - threshold)


def _near(a: Column, b: Column, threshold: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def similar_components(docs: DataFrame, *, n: int = NGRAM, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    common = docs.sparkSession.sparkContext.broadcast(common_ngrams(docs, n))
    fields = "doc_id long, n long, same binary, marks array<long>, needs long, " + ", ".join(f"{c} long" for c in [*SKETCH, "row"])
    with batches_of(docs.sparkSession, BATCH_BYTES):
        described = materialize(docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_describe(n, threshold, common), fields), "ngram-sets")
    usable = described.where("n > 0 and doc_id is not null")
    classes = materialize(usable.groupBy("same").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")), "set-classes")
    names, stored = materialize(described.select("doc_id", "n", "same"), "set-names"), [described]
    # Classes of several rows are a few bytes each, a set's marks some hundred: only beyond the bound are the rows moved.
    copied = classes.where("rows > 1").select("same", "rep")
    if copied.count() <= BROADCAST_IDS:
        reps = usable.join(F.broadcast(copied), "same", "left").where("rep is null or rep = doc_id")
    else:
        named = classes.select("same", F.col("rep").alias("doc_id"))
        # Rows are numbered anew where they lie now, so that those of a block are together.
        reps = usable.join(named, ["same", "doc_id"], "left_semi").withColumn("row", F.monotonically_increasing_id())
        reps = materialize(reps, "set-marks")
        discard(stored.pop())
        stored.append(reps)
    held, grams = (x or 0 for x in reps.agg(F.sum(F.size("marks")), F.sum("n")).first())
    at_once = max(PASS_LEAST, int(grams * PASS_SHARE))
    sets = reps.select("row", "doc_id", "n", "needs", "marks")
    if held <= COUNTED_MARKS:
        slots = docs.sparkSession.sparkContext.broadcast(repeated_marks(reps))
        kept = sets.withColumnRenamed("doc_id", "id").mapInArrow(_keep_repeated(slots, COUNTER_BITS), CANDIDATE)
    else:
        kept = repeated_by_slice(sets, held).groupBy("row", "id", "n", "needs").agg(F.collect_list("mark").alias("marks"))
    with batches_of(docs.sparkSession, BATCH_BYTES):
        stored.append(materialize(kept.mapInArrow(_candidates, CANDIDATE), "repeated-marks"))
        members = shared_marks(stored[-1])
    sketches = materialize(
        reps.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("id"), *SKETCH),
        "sketches",
    )
    discard(*stored)
    texts = docs.where("doc_id is not null")
    if not names.groupBy("doc_id").count().where("count > 1").isEmpty():
        texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))

    def sized(pairs: DataFrame) -> DataFrame:
        return pairs.where(_near(F.col("nu"), F.col("nv"), threshold) & (F.col("u") < F.col("v"))).distinct()

    # First each set against one of the smallest sets of its fragments, that of most of them.
    hubs = members.groupBy("mark").agg(F.min(F.struct("id", "n")).alias("hub"))
    met = members.join(hubs, "mark").where("hub.id <> id").groupBy("id", "n", "hub").agg(F.count("*").alias("both"))
    first = met.groupBy("id", "n").agg(F.max_by("hub", F.struct("both", -F.col("hub.id"))).alias("hub")).select(
        "id", "n", F.col("hub.id").alias("h"), F.col("hub.n").alias("hn"))
    of_hubs = sketches.select(F.col("id").alias("h"), *[F.col(c).alias(f"h{c}") for c in SKETCH])
    first = first.join(sketches, "id").join(of_hubs, "h").where(_may_link(threshold))
    pairs = materialize(sized(first.select(F.col("h").alias("u"), F.col("id").alias("v"), F.col("hn").alias("nu"), F.col("n").alias("nv"))), "pairs")
    links = verify(pairs, texts, n=n, threshold=threshold, at_once=at_once)
    tried, done, many = pairs.select("u", "v"), 0, FIRST_HUBS
    nodes = connected_components(links)
    while True:
        # Fragments in which sets of different components meet.
        labelled = members.join(nodes.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        open_ = labelled.groupBy("mark").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("mark")
        left = materialize(labelled.join(open_, "mark").join(sketches, "id"), "open-fragments")
        counts = left.groupBy("mark").agg(F.count("*").alias("m"))
        largest = counts.agg(F.max("m")).first()[0]
        if largest is None or done >= largest:
            break
        # The next hubs: a share of the fragment's sets by the hash of their ids, about ``many`` of them.
        place = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(2**53)) * F.col("m")
        hubs = left.join(counts, "mark").where((place >= done) & (place < done + many)).select(
            "mark", F.col("id").alias("h"), F.col("n").alias("hn"), F.col("component").alias("hc"), *[F.col(c).alias(f"h{c}") for c in SKETCH])
        met = left.join(hubs, "mark").where((F.col("hc") != F.col("component")) & _may_link(threshold) & _near(F.col("hn"), F.col("n"), threshold))
        new = met.select(
            F.least("h", "id").alias("u"), F.greatest("h", "id").alias("v"),
            F.when(F.col("h") < F.col("id"), F.col("hn")).otherwise(F.col("n")).alias("nu"),
            F.when(F.col("h") < F.col("id"), F.col("n")).otherwise(F.col("hn")).alias("nv"),
        )
        new = materialize(sized(new).join(tried, ["u", "v"], "left_anti"), "pairs")
        if not new.isEmpty():
            found = verify(new, texts, n=n, threshold=threshold, at_once=at_once)
            tried = tried.unionAll(new.select("u", "v"))
            if not found.isEmpty():
                nodes = merged_components(nodes, found)
        discard(left)
        done, many = done + many, many * 4
    discard(left, members, sketches)
    return _result(names, classes, nodes)


def _result(names: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    named = classes.join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
    known = named.select("same", F.coalesce("component", "rep").alias("component_id"))
    joined = names.join(known, "same", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def keep_one(docs: DataFrame, *, n: int = NGRAM, threshold: int = THRESHOLD) -> DataFrame:
    """Of each component the rows with its smallest id; rows equal in id and text stay once, other columns undecided.

    Rows with a null id stay, and so do different texts under one id that stays.
    """
    groups = similar_components(docs, n=n, threshold=threshold)
    gone = materialize(groups.where("component_id <> doc_id").select("doc_id").distinct(), "ids-that-go")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)  # no text is moved
    kept = docs.join(gone, "doc_id", "left_anti")
    repeated = groups.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    single = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    once = kept.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return single.unionAll(once)
