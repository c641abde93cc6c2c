"""Benchmark decontamination by a hash set of normalised test n-grams, in built-in functions.

A window is ``size`` consecutive words of an item; an item with fewer words is one window.
Documents are scanned once and stay in their rows: only windows that hold one of the benchmark's
anchor words (the longest word of each of its windows) are hashed, and such a window is a
candidate if its hash is in the set. A candidate is verified by its words, so a hash never
decides. The sets go with the query as literals, for which the windows are counted first.
Beyond ``SET_LIMIT`` of them the hashes go as a bit filter of at most ``FILTER_BITS``, every window of a
document is tried against it in its row, and the windows that pass are verified by a join on their words.
A fuller filter lets more windows through to the join; it never changes the result.

Defined cases: a null or empty text has no words, and items without words have no window.
Items that repeat, and documents that repeat, each count as rows of their own; item ids that
repeat are one id; null item ids are left out of the list but their windows hit. An empty
benchmark hits nothing. Extra columns are ignored or, where documents are returned, passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import words
from marginalia.operators.groups import BITMAP_BITS, BROADCAST_ROWS, attach_group_facts
from marginalia.session import materialize

WINDOW = 10
SET_LIMIT = 20_000
FILTER_BITS = 1 << 23  # 1 MB
ROW, FOUND, N_WORDS = "__doc_row", "__found", "__n_words"
KINDS = "array<struct<at:int,n:int,gram:string>>"


def _hash(w: Column, start: Column, n: int) -> Column:
    return F.xxhash64(*(F.get(w, start + k) for k in range(n)))


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, n, anchor, hash, gram): the distinct windows of every item, ``n`` words each.

    The anchor is the window's longest word, a stand-in for its rarest; any word would do.
    """
    found = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    found = found.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(size)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)
    each = found.select("item_id", "n", F.explode(F.transform(starts, lambda i: F.slice("w", i, F.col("n")))).alias("g"))
    longest = F.array_sort(F.transform("g", lambda x, i: F.struct((-F.length(x)).alias("l"), i.alias("i"), x.alias("x"))))[0]["x"]
    hashes = F.coalesce(*(F.when(F.col("n") == n, _hash(F.col("g"), F.lit(0), n)) for n in range(1, size + 1)))
    return each.select("item_id", "n", longest.alias("anchor"), hashes.alias("hash"), F.array_join("g", " ").alias("gram")).distinct()


def _quoted(values: set[str]) -> str:
    return ", ".join(f"'{v}'" for v in sorted(values))


def with_found(docs: DataFrame, known: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``N_WORDS`` and ``FOUND``: the verified windows (at, n, gram) of each row."""
    distinct = known.select("n", "anchor", "hash", "gram").distinct()
    if distinct.count() > SET_LIMIT:
        return _found_by_filter(docs, distinct.select("n", "hash", "gram"), keep)
    sets: dict[int, tuple[set, set, set]] = {}
    for row in distinct.collect():
        for group, value in zip(sets.setdefault(row.n, (set(), set(), set())), (row.anchor, row.hash, row.gram)):
            group.add(value)
    read = docs.withColumn("__w", words(F.col("text")))
    found = [F.array().cast(KINDS)]
    for n, (anchors, hashes, grams) in sorted(sets.items()):
        # Words hold no quotes or backslashes. As SQL text, thousands of literals are one call.
        near = f"flatten(transform(__a{n}, i -> sequence(greatest(i - {n - 1}, 0), i)))"
        words_at = ", ".join(f"get(__w, s + {k})" for k in range(n))
        read = read.withColumns({f"__a{n}": F.expr(f"array_compact(transform(__w, (x, i) -> if(x in ({_quoted(anchors)}), i, null)))")})
        read = read.withColumn(f"__s{n}", F.expr(f"""filter(array_distinct({near}),
            s -> s + {n} <= size(__w) and xxhash64({words_at}) in ({", ".join(f"{h}L" for h in sorted(hashes))}))"""))
        found.append(F.expr(f"""filter(
            transform(__s{n}, s -> named_struct('at', s, 'n', {n}, 'gram', concat_ws(' ', {words_at}))),
            c -> c.gram in ({_quoted(grams)}))"""))
    return read.select(*keep, F.size("__w").cast("long").alias(N_WORDS), F.concat(*found).alias(FOUND))


def _hash_filter(known: DataFrame, bits: int) -> bytes:
    """One bit for the hash of every window; the driver sees at most ``bits / BITMAP_BITS`` parts of 4 kB."""
    slot = F.pmod(F.col("hash"), F.lit(bits)) + 1
    parts = known.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bitmap"))
    size = BITMAP_BITS // 8
    whole = bytearray(bits // 8)
    for row in parts.collect():
        whole[(row.part - 1) * size : row.part * size] = row.bitmap
    return bytes(whole)


def _found_by_filter(docs: DataFrame, known: DataFrame, keep: list[str]) -> DataFrame:
    """The same for a benchmark of any size: no window of a document moves unless its hash may be known."""
    rows = materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "window-rows")
    read = rows.select(ROW, words(F.col("text")).alias("__w"))
    w, lengths = F.col("__w"), sorted(r.n for r in known.select("n").distinct().collect())
    table = F.lit(_hash_filter(known, FILTER_BITS))

    def may_be_known(c: Column) -> Column:
        slot = F.pmod(c["hash"], F.lit(FILTER_BITS)).cast("int")
        byte = F.conv(F.hex(F.substring(table, F.shiftright(slot, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, slot % 8) == 1

    def passing(n: Column) -> Column:
        # One expression for all lengths, so that the plan holds the filter once.
        window = lambda s: F.struct(
            s.alias("at"), n.alias("n"), F.coalesce(*(F.when(n == k, _hash(w, s, k)) for k in lengths)).alias("hash"))
        return F.when(F.size(w) >= n, F.filter(F.transform(F.sequence(F.lit(0), F.size(w) - n), window), may_be_known))

    passed = F.flatten(F.array_compact(F.transform(F.array(*map(F.lit, lengths)), passing)))
    named = F.transform(passed, lambda c: F.struct(
        c["at"].alias("at"), c["n"].alias("n"), F.array_join(F.slice(w, c["at"] + 1, c["n"]), " ").alias("gram")))
    likely = read.select(ROW, F.explode(named).alias("c")).select(ROW, "c.at", "c.n", "c.gram")
    grams = known.select("n", "gram")
    grams = F.broadcast(grams) if grams.count() <= BROADCAST_ROWS else grams
    hits = likely.join(grams, ["n", "gram"], "left_semi").groupBy(ROW).agg(
        F.collect_list(F.struct("at", "n", "gram")).alias(FOUND), F.lit(1).alias("__rows"))
    # Only rows with a hit leave their place, and only if there are many.
    met = attach_group_facts(rows, materialize(hits, "window-hits"), ROW, "__rows")
    return met.select(
        *keep, F.size(words(F.col("text"))).cast("long").alias(N_WORDS),
        F.coalesce(F.col(FOUND), F.array().cast(KINDS)).alias(FOUND))


def covered(spans: Column) -> Column:
    """Words inside any of the (at, n) spans, which are sorted; overlaps count once."""
    start = F.struct(F.lit(0).cast("int").alias("end"), F.lit(0).cast("long").alias("words"))
    return F.aggregate(spans, start, lambda a, s: F.struct(
        F.greatest(a.end, s["at"] + s.n).alias("end"),
        (a.words + F.greatest(F.lit(0), s["at"] + s.n - F.greatest(a.end, s["at"]))).alias("words"),
    )).words


def find_hits(docs: DataFrame, items: DataFrame, *, keep: list[str], size: int = WINDOW) -> DataFrame:
    """One row per document: ``keep``, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``spans`` are the windows found (at, n), words from 0. Stored once: the scan is not repeated.
    """
    known = materialize(windows(items, size), "windows")
    scanned = with_found(docs.select(*dict.fromkeys([*keep, "text"])), known, keep)
    scanned = materialize(scanned.withColumn(ROW, F.monotonically_increasing_id()), "window-scan")
    hit = scanned.select(ROW, F.explode(F.array_distinct(F.transform(FOUND, lambda c: c["gram"]))).alias("gram"))
    named = hit.join(known.where("item_id is not null").select("item_id", "gram").distinct(), "gram")
    each = named.groupBy(ROW).agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    out = scanned.join(each, ROW, "left").withColumns({
        "ids": F.coalesce("ids", F.array().cast("array<string>")),
        "spans": F.array_sort(F.transform(FOUND, lambda c: F.struct(c["at"].alias("at"), c["n"].alias("n")))),
    })
    return out.select(
        *keep, F.col(N_WORDS).alias("n_words"), covered(F.col("spans")).alias("n_hit"),
        F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"), "spans",
    )


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words inside the (at, n) spans; what stands between words stays."""
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    between = F.split(text, word, -1)
    inside = lambda i: F.exists(spans, lambda s: (i >= s["at"]) & (i < s["at"] + s["n"]))
    kept = F.transform(
        F.regexp_extract_all(text, F.lit(f"({word})"), F.lit(1)),
        lambda w, i: F.concat(F.when(inside(i), F.lit("")).otherwise(w), F.get(between, i + 1)),
    )
    return F.concat(F.get(between, F.lit(0)), F.array_join(kept, ""))


def clean(docs: DataFrame, items: DataFrame, *, size: int = WINDOW, spans: bool = False) -> DataFrame:
    """The documents without benchmark windows, all columns kept.

    With ``spans`` hit documents stay and lose the words inside the windows, else they go.
    """
    known = materialize(windows(items, size), "windows")
    found = with_found(docs, known, docs.columns)
    if spans:
        cut = without_spans(F.col("text"), F.col(FOUND))
        return found.withColumn("text", F.when(F.size(FOUND) > 0, cut).otherwise(F.col("text"))).select(*docs.columns)
    # A filter on FOUND alone would be pushed below it, and the whole scan copied into the condition.
    numbered = found.withColumn(ROW, F.monotonically_increasing_id())
    return numbered.where((F.size(FOUND) == 0) & (F.col(ROW) >= 0)).select(*docs.columns)
