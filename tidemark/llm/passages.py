"""Substring dedup: repeated passages by collinear chaining of shared word k-mers.

Every document is reduced to minimizers: of each WINDOW consecutive k-mers of K words the one
with the smallest hash.  Any K + WINDOW - 1 equal words in two documents share one.  The
seeds of a hash are not paired with each other: each is matched with the hash's first
document only, so matches grow with the input and a passage in very many documents is a star
around the first.  Matches of two documents are chained in order by a prefix-maximum
Fenwick tree with linear gap costs and parted at wide gaps.  Chains are then aligned on the
words: their ends are extended over equal words and single changes, and a passage is kept
if it has at least LEAST words and its K-word shingles have Jaccard similarity SIMILAR or
more; a chain that fails is parted at its widest gap and tried again.

A hash's first document need not hold the whole passage, nor its first place there.  So where
seeds of a later document are in no passage and came first in different documents, links of
two (next to each other, or with one left out) and four of its shared seeds in a row are
matched as one, with the first document and place that have the same seeds so linked: that is
a star again, but only around documents that hold more of the passage.  Links reach over a
changed word, and over a seed that only one of the two places has.  Last, where a later document has
WIDE words after a seed in common with another and no passage covers them, all windows of
LEAST words there are matched with the first document and place that hold the same window:
LEAST equal words in a row are always covered.  A passage with a changed word and without
LEAST equal words in a row is lost only where all its links came first in other places, too.  Words are compared with A-Z lower-cased.

Tasks that send seeds, blocks of words or texts to a join first ask a table of bits of fixed
size whether the other side may hold the key.

Defined cases: null and empty texts and texts of fewer than K words have no passage; rows
without doc_id take no part.  Rows equal in id and text count once; rows that share an id
with different texts are told apart by a hash of the text, and never compared with each
other.  Repeats within one document are not reported, extra columns not read; an empty table
gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import compress, count
from operator import ne

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bit_filter, map_columns, query, read, utf8, written
from tidemark.operators.publish import discard
from tidemark.sources.lake import work_folder

K, WINDOW = 5, 12
LEAST, SIMILAR = 50, 0.8
GAP_COST = 0.1  # per word between two matches, against K for a match
WIDEST, SHIFT = 40, 20  # words between matches of one chain, and how far they may shift
MARGIN = 64  # words fetched beyond a chain's ends
BLOCK = 128  # words of a text moved together
DROP = 12  # an extension ends when its score falls this far below its best
CHANGE = 5  # what a changed word costs, against 1 for an equal one
WIDE = LEAST - WINDOW + 1  # of LEAST equal words, at least so many follow from the first seed on
MIX = np.uint64(0x9E3779B97F4A7C15)
WHOLE = (-1).to_bytes(4, "little", signed=True)  # in place of a block number
LINKS = ((0, 1), (0, 2), (0, 1, 2, 3))  # seeds that are matched together, by their order from one on


def minimizers(hashes: np.ndarray, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
    """Places of the smallest hash of each window: those that are as large as the largest
    minimum of the windows around them.  Texts begin and end at ``starts`` and ``ends``; one
    shorter than a window is a window of its own."""
    if starts is None:
        starts, ends = np.array([0]), np.array([len(hashes)])
    if not len(hashes) or not len(starts):
        return np.empty(0, dtype=np.int64)
    short = ends - starts < WINDOW
    small = [
        a + np.flatnonzero(hashes[a:z] == hashes[a:z].min()) for a, z in zip(starts[short].tolist(), ends[short].tolist())
    ]
    if not short.all():
        minima = sliding(np.minimum, hashes, WINDOW)
        # Windows that reach from one text into the next do not count.
        step = np.zeros(len(hashes) + 1, dtype=np.int8)
        step[starts[~short]] = 1
        step[ends[~short] - WINDOW + 1] = -1
        minima *= np.cumsum(step)[: len(minima)].astype(np.uint64)
        edge = np.zeros(WINDOW - 1, dtype=np.uint64)
        small.append(np.flatnonzero(sliding(np.maximum, np.concatenate([edge, minima, edge]), WINDOW) == hashes))
    return np.sort(np.concatenate(small))


def sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` values in a row."""
    size = 1
    while 2 * size <= width:
        values, size = best(values[:-size], values[size:]), 2 * size
    return best(values[: size - width], values[width - size :]) if size < width else values


def stirred(mixed: np.ndarray) -> np.ndarray:
    return (mixed ^ (mixed >> np.uint64(29))) * MIX


BLANKS = np.isin(np.arange(256), list(b" \t\n\v\f\r"))  # where bytes.split() cuts
PIECE = 1 << 16  # bytes hashed together
BASE = int(MIX)
LETTERS = stirred(stirred(np.arange(1, 257, dtype=np.uint64) * MIX))
POWERS, INVERSE = (
    np.cumprod(np.full(PIECE, base, dtype=np.uint64)) for base in (BASE, pow(BASE, -1, 1 << 64))
)


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a text, A-Z lower-cased, and the bytes they begin at.

    The hash is a polynomial of the letters' values, so that differences of running sums give
    those of all words of a piece at once.  A word longer than a piece is hashed by itself.
    """
    text = text.lower()
    letters = np.frombuffer(text, dtype=np.uint8)
    blank = np.ones(len(letters) + 2, dtype=bool)
    blank[1:-1] = BLANKS[letters]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), dtype=np.uint64)
    low = 0
    while low < len(starts):
        begin = int(starts[low])
        high = int(np.searchsorted(ends, begin + PIECE, side="right"))
        if high == low:
            hashes[low] = xxhash.xxh64_intdigest(text[begin : int(ends[low])])
            low += 1
            continue
        piece = letters[begin : int(ends[high - 1])]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(LETTERS[piece] * POWERS[: len(piece)], out=sums[1:])
        at = starts[low:high] - begin
        hashes[low:high] = (sums[ends[low:high] - begin] - sums[at]) * INVERSE[at]
        low = high
    return hashes, starts


def gram_hashes(one: np.ndarray) -> np.ndarray:
    """Hashes of every K words in a row, put together from those of the words; none if there
    are fewer words."""
    n = max(len(one) - K + 1, 0)
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(K):
        mixed = stirred(mixed) + one[i : i + n]
    return stirred(mixed)


def together(texts: Iterator[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Several texts at once, PIECE bytes or one text: the numbers of those with K words or
    more, the hashes of every K words in a row, and where those of each text begin and end (what
    lies between reaches from one text into the next)."""

    def grams(numbers, parts):
        one, at = word_hashes(b" ".join(parts))
        begins = np.cumsum([0] + [len(part) + 1 for part in parts])
        firsts = np.searchsorted(at, begins)
        several = np.diff(firsts) >= K
        return np.array(numbers)[several], gram_hashes(one), firsts[:-1][several], firsts[1:][several] - K + 1

    numbers, parts, size = [], [], 0
    for number, text in enumerate(texts):
        numbers.append(number)
        parts.append(text)
        size += len(text)
        if size >= PIECE:
            yield grams(numbers, parts)
            numbers, parts, size = [], [], 0
    if parts:
        yield grams(numbers, parts)


def spans(hashes: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Hashes of ``length`` words from each place, put together from those of the k-mers."""
    mixed = np.zeros(len(places), dtype=np.uint64)
    for offset in (*range(0, length - K, K), length - K):
        mixed = stirred(mixed) + hashes[places + offset]
    return mixed


def seeds(docs: DataFrame) -> DataFrame:
    """hash, doc_id, tag, pos of the minimizers of each document, and the hash of the WIDE words
    from there (32 bits, used beside ``hash``), null where fewer are left."""

    def found(ids, tags, texts):
        for numbers, hashes, starts, ends in together(utf8(texts)):
            places = minimizers(hashes, starts, ends)
            if len(places):
                text = np.searchsorted(starts, places, side="right") - 1
                long = places < ends[text] - (WIDE - K)
                wide = np.zeros(len(places), dtype=np.uint32)
                wide[long] = spans(hashes, places[long], WIDE) >> np.uint64(32)
                pick = pa.array(numbers[text])
                yield [
                    hashes[places].view(np.int64), ids.take(pick), tags.take(pick),
                    (places - starts[text]).astype(np.int32), pa.array(wide.view(np.int32), mask=~long),
                ]

    return map_columns(
        docs.where("doc_id IS NOT NULL"), found, "hash long, doc_id long, tag int, pos int, wide int",
        F.col("doc_id").cast("long"), text_tag(), F.col("text"),
    )


def text_tag() -> Column:
    """32 bits that tell texts under one id apart."""
    return F.hash("text")


def shared_seeds(found: DataFrame) -> DataFrame:
    """The seeds whose hash another document has too, with the first of these documents."""
    spread = found.groupBy("hash").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    several = written(spread.where("first_id < last_id").select("hash", "first_id"))
    return held(found, "hash", several).join(several, "hash")


def held(rows: DataFrame, name: str, wanted: DataFrame) -> DataFrame:
    """The rows whose hash may be among those of ``wanted``: so that a join with it moves
    these only."""
    shared = rows.sparkSession.sparkContext.broadcast(bit_filter(wanted, name))
    place = rows.columns.index(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(place).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(shared.value.holds(hashes)))

    return rows.mapInArrow(run, rows.schema)


def first_places(rows: DataFrame, key: str, place: str) -> DataFrame:
    """first_id, first_tag and first_pos of the first of the rows with each key, by document."""
    at = F.struct("doc_id", "tag", place)
    return written(rows.groupBy(key).agg(F.min(at).alias("at")).select(
        key, F.col("at.doc_id").alias("first_id"), F.col("at.tag").alias("first_tag"),
        F.col(f"at.{place}").alias("first_pos"),
    ))


def matches(shared: DataFrame) -> DataFrame:
    """doc_id, tag, pos against the first document with the same hash: first_id, first_tag,
    first_pos."""
    # Where a hash comes several times in its first document, its first place counts; what is
    # lost by that is found by its longer windows.
    firsts = first_places(shared.where("doc_id = first_id"), "hash", "pos")
    return (
        shared.where("doc_id <> first_id").drop("first_id").join(firsts, "hash")
        .select("doc_id", "tag", "first_id", "first_tag", "pos", "first_pos")
    )


def complete(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole groups, many groups at once, and the number of each row's group; rows
    with equal keys follow each other."""
    carry = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if carry is not None:
            table = pa.concat_tables([carry, table]).combine_chunks()
        if not table.num_rows:
            continue
        number = numbered(table, keys)
        end = int(np.searchsorted(number, number[-1]))
        if end:
            yield table.slice(0, end).combine_chunks(), number[:end]
        carry = table.slice(end).combine_chunks()
    if carry is not None and carry.num_rows:
        yield carry, numbered(carry, keys)


def numbered(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, dtype=bool)
    for key in keys:
        values = table[key].to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.cumsum(change)


def runs_of(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and row after the last of each group."""
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    return starts, np.append(starts[1:], len(number))


def chains(pos: np.ndarray, rep: np.ndarray) -> list[np.ndarray]:
    """Indexes of the matches (in the order of ``pos``) of each chain."""
    n = len(pos)
    if n > 1 and (np.diff(rep) > 0).all():
        found = [np.arange(n)]
    else:
        found = _fenwick_chains(pos.tolist(), rep.tolist())
    out = []
    for chain in found:
        p, r = np.diff(pos[chain]), np.diff(rep[chain])
        out += np.split(chain, np.flatnonzero((p > WIDEST) | (r > WIDEST) | (np.abs(p - r) > SHIFT)) + 1)
    return [chain for chain in out if len(chain) > 1]


def _fenwick_chains(pos: list[int], rep: list[int]) -> list[np.ndarray]:
    n = len(pos)
    rank = {value: i + 1 for i, value in enumerate(sorted(set(rep)))}
    size = len(rank)
    best: list[tuple[float, int]] = [(0.0, -1)] * (size + 1)
    score, before = [0.0] * n, [-1] * n
    for i in range(n):
        here, at = GAP_COST * (pos[i] + rep[i]), rank[rep[i]]
        top = (0.0, -1)
        j = at - 1
        while j > 0:
            top = max(top, best[j])
            j -= j & -j
        gain = top[0] - here
        score[i], before[i] = (K + gain, top[1]) if top[1] >= 0 and gain > 0 else (float(K), -1)
        value = (score[i] + here, i)
        j = at
        while j <= size:
            best[j] = max(best[j], value)
            j += j & -j
    used, out = [False] * n, []
    for end in sorted(range(n), key=lambda i: (-score[i], i)):
        chain = []
        while end >= 0 and not used[end]:
            used[end] = True
            chain.append(end)
            end = before[end]
        if len(chain) > 1:
            out.append(np.array(chain[::-1]))
    return out


PAIR = ["doc_id", "tag", "first_id", "first_tag"]


def chained(found: DataFrame) -> DataFrame:
    """One row per chain: the two documents and the places of its matches in both."""

    def run(batches):
        for table, number in complete(batches, PAIR):
            pos, rep = table["pos"].to_numpy(), table["first_pos"].to_numpy()
            starts, ends = runs_of(number)
            several = ends - starts > 1  # one match is no chain
            owners, ours, theirs = [], [], []
            for a, z in zip(starts[several].tolist(), ends[several].tolist()):
                for chain in chains(pos[a:z], rep[a:z]):
                    owners.append(a)
                    ours.append(pos[a:z][chain])
                    theirs.append(rep[a:z][chain])
            if owners:
                yield pa.RecordBatch.from_arrays(
                    [
                        *(table[name].combine_chunks().take(pa.array(owners)) for name in PAIR),
                        pa.array(ours, type=pa.list_(pa.int32())), pa.array(theirs, type=pa.list_(pa.int32())),
                    ],
                    [*PAIR, "pos", "first_pos"],
                )

    dealt = found.repartition(*PAIR).sortWithinPartitions(*PAIR, "pos")
    return dealt.mapInArrow(
        run, "doc_id long, tag int, first_id long, first_tag int, pos array<int>, first_pos array<int>"
    )


def text_hash() -> Column:
    """Of id and tag of a text; with the number of a block after it, of the block."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_tag())


def blocks(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The words of each document, BLOCK at a time, as far as ``asked`` (doc_id, tag, block)
    may hold them; texts without such a block are not taken apart."""
    texts = asked.select("doc_id", "tag", F.lit(-1).alias("block")).distinct()
    hashed = asked.select("doc_id", "tag", "block").distinct().union(texts).select(
        F.xxhash64("doc_id", "tag", "block").alias("h")
    )
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(hashed, "h"))

    def cut(ids, tags, hashes, texts):
        known = shared.value
        first = xxhash.xxh64_intdigest
        seeds = hashes.to_numpy().view(np.uint64).tolist()
        whole = known.holds(np.array([first(WHOLE, h) for h in seeds], dtype=np.uint64))
        pick = pa.array(np.flatnonzero(whole))
        for doc, mark, h, text in zip(
            ids.take(pick).to_pylist(), tags.take(pick).to_pylist(), np.array(seeds, dtype=np.uint64)[whole].tolist(),
            utf8(texts.take(pick)),
        ):
            words = text.lower().split()
            if len(words) >= K:
                n = -(-len(words) // BLOCK)
                numbers = np.flatnonzero(
                    known.holds(np.array([first(i.to_bytes(4, "little"), h) for i in range(n)], dtype=np.uint64))
                )
                parts = [b" ".join(words[i * BLOCK : (i + 1) * BLOCK]) for i in numbers.tolist()]
                n = len(parts)
                yield [
                    np.full(n, doc, dtype=np.int64), np.full(n, mark, dtype=np.int32),
                    numbers.astype(np.int32), pa.array(parts, type=pa.binary()),
                ]

    return map_columns(
        docs.where("doc_id IS NOT NULL"), cut, "doc_id long, tag int, block int, words binary",
        F.col("doc_id").cast("long"), text_tag(), text_hash(), F.col("text"),
    )


def extend(a: list, i: int, b: list, j: int, step: int, change: int = CHANGE) -> int:
    """How many words both sides go on together from i and j: equal words with changes
    between, as far as the score is best."""
    most = max(0, min((len(a) - i, len(b) - j) if step > 0 else (i + 1, j + 1)))
    ours, theirs = (w[at : at + most] if step > 0 else w[at + 1 - most : at + 1][::-1] for w, at in ((a, i), (b, j)))
    # Up to the first change there is nothing to weigh.
    best = score = taken = next(compress(count(), map(ne, ours, theirs)), most)
    for n in range(taken, most):
        if ours[n] == theirs[n]:
            score += 1
            if score > best:
                best, taken = score, n + 1
        else:
            score -= change
            if score <= best - DROP:
                break
    return taken


def shingles(a: list, b: list) -> list[list[int]]:
    """The K-word shingles of both sides as numbers, equal ones with the same."""
    number: dict[tuple, int] = {}
    return [[number.setdefault(shingle, len(number)) for shingle in zip(*(w[i:] for i in range(K)))] for w in (a, b)]


def align(a: list, a_first: int, b: list, b_first: int, pos: np.ndarray, rep: np.ndarray) -> Iterator[tuple]:
    """(start, end, first_start, first_end, similarity) of the passages along a chain; ``a``
    and ``b`` hold the words from ``a_first`` and ``b_first`` on."""
    todo, numbers = [(pos, rep)], None
    while todo:
        pos, rep = todo.pop()
        back, on = (
            [extend(a, i - a_first, b, j - b_first, step, change) for change in (CHANGE, DROP)]  # DROP: to the first change
            for i, j, step in ((int(pos[0]) - 1, int(rep[0]) - 1, -1), (int(pos[-1]) + K, int(rep[-1]) + K, 1))
        )
        # Both ends over changes, else one of them, else none.
        for less, more in dict.fromkeys((less, more) for less in back for more in on):
            start, end = int(pos[0]) - less, int(pos[-1]) + K + more
            first_start, first_end = int(rep[0]) - less, int(rep[-1]) + K + more
            if min(end - start, first_end - first_start) < LEAST:
                continue
            ours, theirs = (start - a_first, end - a_first), (first_start - b_first, first_end - b_first)
            if a[slice(*ours)] == b[slice(*theirs)]:
                similarity = 1.0
            else:
                # Numbered once for all that is tried along the chain.
                numbers = numbers or shingles(a, b)
                one, two = (set(w[low : high - K + 1]) for w, (low, high) in zip(numbers, (ours, theirs)))
                shared = len(one & two)
                similarity = shared / (len(one) + len(two) - shared)  # Jaccard
            if similarity >= SIMILAR:
                yield start, end, first_start, first_end, similarity
                break
        else:
            if len(pos) > 2:
                at = int(np.argmax(np.diff(pos) + np.diff(rep))) + 1
                todo += [part for part in ((pos[:at], rep[:at]), (pos[at:], rep[at:])) if len(part[0]) > 1]


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path``; smaller than a checkpoint."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def aligned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The passages along chains, with the tag of their document."""
    linked = written(found.withColumn("chain", F.monotonically_increasing_id()))

    def wanted(role, name, mark, places):
        low = F.greatest(F.element_at(places, 1) - MARGIN, F.lit(0))
        high = F.element_at(places, -1) + K + MARGIN
        return linked.select(
            "chain", F.lit(role).alias("role"), F.col(name).alias("doc_id"), F.col(mark).alias("tag"),
            F.explode(F.sequence(F.floor(low / BLOCK).cast("int"), F.floor(high / BLOCK).cast("int"))).alias("block"),
        )

    asked = wanted(1, "doc_id", "tag", "pos").union(wanted(2, "first_id", "first_tag", "first_pos"))
    pieces = asked.join(blocks(docs, asked), ["doc_id", "tag", "block"]).select("chain", "role", "block", "words")
    none = lambda kind: F.lit(None).cast(kind)
    heads = linked.select(
        "chain", F.lit(0).alias("role"), F.lit(0).alias("block"), F.lit(None).cast("binary").alias("words"),
        "doc_id", "tag", "first_id", "pos", "first_pos",
    )
    rows = heads.union(
        pieces.select(
            "chain", "role", "block", "words", none("long"), none("int"), none("long"), none("array<int>"),
            none("array<int>"),
        )
    )

    def run(batches):
        for table, number in complete(batches, ["chain"]):
            roles, numbers = table["role"].to_numpy(), table["block"].to_numpy().tolist()
            texts = table["words"].to_pylist()
            starts, ends = runs_of(number)
            # The head comes first in each group, then the blocks of one side and of the other.
            heads = table.take(pa.array(starts))
            places = zip(heads["pos"].to_pylist(), heads["first_pos"].to_pylist())
            middles = starts + 1 + np.add.reduceat(roles == 1, starts)
            owners, found = [], []
            for head, (a, m, z, (pos, rep)) in enumerate(zip(starts.tolist(), middles.tolist(), ends.tolist(), places)):
                sides = []
                for low, high in ((a + 1, m), (m, z)):
                    # A row repeated in the input gives the same block again.
                    own = dict(zip(numbers[low:high], texts[low:high]))
                    sides += [b" ".join(own.values()).split(b" "), numbers[low] * BLOCK]
                for passage in align(*sides, np.array(pos), np.array(rep)):
                    owners.append(head)
                    found.append(passage)
            if found:
                start, end, first_start, first_end, similarity = zip(*found)
                kept = heads.take(pa.array(owners))
                yield pa.RecordBatch.from_arrays(
                    [
                        kept["doc_id"].combine_chunks(), kept["tag"].combine_chunks(),
                        pa.array(start, type=pa.int32()), pa.array(end, type=pa.int32()),
                        kept["first_id"].combine_chunks(),
                        pa.array(first_start, type=pa.int32()), pa.array(first_end, type=pa.int32()),
                        pa.array(similarity, type=pa.float64()),
                    ],
                    ["doc_id", "tag", "start_word", "end_word", "first_doc_id", "first_start", "first_end", "similarity"],
                )

    return rows.repartition("chain").sortWithinPartitions("chain", "role", "block").mapInArrow(
        run,
        "doc_id long, tag int, start_word int, end_word int, first_doc_id long, first_start int, first_end int,"
        " similarity double",
    )


def marked(shared: DataFrame, accepted: DataFrame) -> DataFrame:
    """The seeds that other documents have too, with keys that say more than their hash:
    ``wide`` of the WIDE words from there, and ``link0``, ... of the seeds of each of LINKS, the
    last of them at ``last0``, ... (all null where there are no more).

    ``wide`` is open where an earlier document has the seed and the words reach out of the
    accepted passages of this document.  A link is open where it begins beyond those and its
    seeds came first in different earlier documents: one that holds all of them has been
    compared with already.
    """
    none = lambda kind: F.lit(None).cast(kind)
    rows = shared.select("doc_id", "tag", "pos", "hash", "wide", "first_id", none("int").alias("end"))
    rows = rows.unionByName(accepted.select(
        "doc_id", "tag", F.col("start_word").alias("pos"), none("long").alias("hash"), none("int").alias("wide"),
        none("long").alias("first_id"), F.col("end_word").alias("end"),
    ))

    def run(batches):
        for table, number in complete(batches, ["doc_id", "tag"]):
            column = {name: table[name].combine_chunks() for name in table.column_names}
            passages = column["end"].is_valid().to_numpy(zero_copy_only=False)
            # How far the passages of a document that begin at a place or before reach.
            ends = np.where(passages, column["end"].fill_null(0).to_numpy(), 0) + (number << 32)
            seeds = np.flatnonzero(~passages)
            if not len(seeds):
                continue
            reach = (np.maximum.accumulate(ends) - (number << 32))[seeds]
            number, at = number[seeds], column["pos"].to_numpy()[seeds]
            doc, first = column["doc_id"].to_numpy()[seeds], column["first_id"].fill_null(0).to_numpy()[seeds]
            hashes = column["hash"].fill_null(0).to_numpy()[seeds].view(np.uint64)
            wide = column["wide"].is_valid().to_numpy(zero_copy_only=False)[seeds]
            value = column["wide"].fill_null(0).to_numpy()[seeds].astype(np.int64).view(np.uint64)
            n, late = len(seeds), doc > first
            out = [
                pa.array(doc), column["tag"].take(pa.array(seeds)), pa.array(at),
                pa.array(stirred(hashes + stirred(value)).view(np.int64), mask=~wide),
                pa.array(late & (reach < at + LEAST) & wide),
            ]
            for link in LINKS:
                m = max(n - link[-1], 0)
                mixed, last = np.full(n, len(link), dtype=np.uint64), np.zeros(n, dtype=np.int32)
                close, several, known = (np.zeros(n, dtype=bool) for _ in range(3))
                known[:m] = True
                close[:m] = number[:m] == number[n - m :]
                for i in link:
                    mixed[:m] = stirred(mixed[:m]) + hashes[i : i + m]
                    several[:m] |= first[i : i + m] != first[:m]
                    known[:m] &= late[i : i + m]
                last[:m] = at[n - m :]
                for i, j in zip(link, link[1:]):
                    close[:m] &= at[j : j + m] - at[i : i + m] <= WIDEST
                out += [
                    pa.array(stirred(mixed).view(np.int64), mask=~close), pa.array(last, mask=~close),
                    pa.array(close & several & known & (reach <= at)),
                ]
            yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, tag int, pos int, wide long, open_wide boolean" + "".join(
        f", link{n} long, last{n} int, open{n} boolean" for n in range(len(LINKS))
    )
    names = [part.split()[0] for part in schema.split(", ")]
    # Passages come before seeds at the same place.
    dealt = rows.repartition("doc_id", "tag").sortWithinPartitions("doc_id", "tag", "pos", F.col("end").desc_nulls_last())
    return dealt.mapInArrow(run, schema)


WINDOWS = len(LINKS)  # the kind of key that is no link


def asked_keys(rows: DataFrame) -> DataFrame:
    """kind, key, doc_id, tag, pos, last, open of the rows of :func:`marked` whose key may be
    open in some row: one scan for the open keys, one for the rows."""
    names = [(f"link{n}", f"last{n}", f"open{n}") for n in range(len(LINKS))] + [("wide", "pos", "open_wide")]
    opened = rows.where(" OR ".join(flag for *_, flag in names)).select(
        F.explode(F.array(*(F.when(F.col(flag), F.col(key)) for key, _, flag in names))).alias("key")
    )
    shared = rows.sparkSession.sparkContext.broadcast(bit_filter(opened, "key"))

    def run(docs, tags, places, *columns):
        for kind in range(len(names)):
            keys, last, flag = columns[3 * kind : 3 * kind + 3]
            hashes = keys.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            known = keys.is_valid().to_numpy(zero_copy_only=False)
            pick = pa.array(np.flatnonzero(known & shared.value.holds(hashes)))
            if len(pick):
                yield [
                    np.full(len(pick), kind, dtype=np.int32), keys.take(pick), docs.take(pick), tags.take(pick),
                    places.take(pick), last.take(pick), flag.take(pick),
                ]

    return map_columns(
        rows, run, "kind int, key long, doc_id long, tag int, pos int, last int, open boolean",
        F.col("doc_id"), F.col("tag"), F.col("pos"), *(F.col(c) for name in names for c in name),
    )


def linked_matches(asked: DataFrame) -> DataFrame:
    """As :func:`matches`, of open links: their first and last seeds, matched with the first
    document and place that have the same link."""
    links = asked.where(F.col("kind") < WINDOWS)
    # Two seeds next to each other here may have one between them there, so kinds do not matter.
    firsts = links.groupBy("key").agg(
        F.min(F.struct("doc_id", "tag", "pos", "last")).alias("at"), F.max("doc_id").alias("high")
    )
    pairs = links.where("open").join(written(firsts.where("at.doc_id < high").drop("high")), "key")
    ends = F.explode(F.array(
        F.struct(F.col("pos").alias("here"), F.col("at.pos").alias("there")),
        F.struct(F.col("last").alias("here"), F.col("at.last").alias("there")),
    ))
    return pairs.where("doc_id <> at.doc_id").select("doc_id", "tag", "at", ends.alias("end")).select(
        "doc_id", "tag", F.col("at.doc_id").alias("first_id"), F.col("at.tag").alias("first_tag"),
        F.col("end.here").alias("pos"), F.col("end.there").alias("first_pos"),
    ).distinct()


def open_windows(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """key, doc_id, tag and start of windows of LEAST words: those around seeds whose WIDE words
    another document has too, if for one of the later documents they reach out of its passages."""
    rows = asked.where(F.col("kind") == WINDOWS).select("key", "doc_id", "tag", "pos", "open")
    keys = rows.groupBy("key").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max("open").alias("any")
    )
    near = rows.join(written(keys.where("any AND low < high").select("key")), "key")
    asked = written(near.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set("pos")).alias("places")))
    texts = held(
        docs.where("doc_id IS NOT NULL").select(
            F.col("doc_id").cast("long").alias("doc_id"), text_tag().alias("tag"), text_hash().alias("h"), "text"
        ),
        "h", asked.select(F.xxhash64("doc_id", "tag").alias("h")),
    )

    def cut(ids, tags, places, texts):
        for doc, mark, near, text in zip(ids.to_pylist(), tags.to_pylist(), places, utf8(texts)):
            near = near.values.to_numpy()
            low = max(int(near[0]) - WINDOW + 1, 0)
            hashes = gram_hashes(word_hashes(text)[0][low : int(near[-1]) + LEAST])
            n = len(hashes) - (LEAST - K)
            if n <= 0:
                continue
            seeded = np.zeros(n + WINDOW - 1, dtype=bool)
            seeded[(near - low)[near - low < len(seeded)]] = True
            starts = np.flatnonzero(sliding(np.maximum, seeded, WINDOW))
            if len(starts):
                yield [
                    spans(hashes, starts, LEAST).view(np.int64), np.full(len(starts), doc, dtype=np.int64),
                    np.full(len(starts), mark, dtype=np.int32), (starts + low).astype(np.int32),
                ]

    return map_columns(
        texts.join(asked, ["doc_id", "tag"]), cut, "key long, doc_id long, tag int, start int",
        F.col("doc_id"), F.col("tag"), F.col("places"), F.col("text"),
    )


def uncovered(windows: DataFrame, accepted: DataFrame) -> DataFrame:
    """Chains, as of :func:`chained`, of equal windows that are in no accepted passage."""
    firsts = first_places(windows, "key", "start")
    pairs = windows.join(firsts, "key").where("doc_id <> first_id").select(
        "doc_id", "tag", "first_id", "first_tag", F.col("start").alias("pos"), "first_pos"
    )
    rows = pairs.unionByName(
        accepted.select(
            "doc_id", "tag", F.lit(None).cast("long").alias("first_id"), F.lit(None).cast("int").alias("first_tag"),
            F.col("start_word").alias("pos"), F.col("end_word").alias("first_pos"),
        )
    )

    def run(batches):
        for table, number in complete(batches, ["doc_id", "tag"]):
            column = {name: table[name].combine_chunks() for name in table.column_names}
            windows = column["first_id"].is_valid().to_numpy(zero_copy_only=False)
            column = {name: values.fill_null(0).to_numpy() for name, values in column.items()}
            before = np.flatnonzero(~windows)
            before = before[np.lexsort((column["pos"][before], number[before]))]
            runs = equal_runs(number, column, np.flatnonzero(windows))
            # Runs and passages of each document, numbered as the documents are.
            groups = np.arange(number[-1] + 2)
            cuts = np.searchsorted(number[runs["row"]], groups).tolist()
            known = np.searchsorted(number[before], groups).tolist()
            reached = list(zip(column["pos"][before].tolist(), column["first_pos"][before].tolist()))
            stretches = list(zip(*(runs[name].tolist() for name in ("row", "start", "end", "first_start"))))
            owners, found = [], []
            for group in np.flatnonzero(np.diff(cuts)).tolist():
                for row, *stretch in cover(
                    stretches[cuts[group] : cuts[group + 1]], reached[known[group] : known[group + 1]]
                ):
                    owners.append(row)
                    found.append((int(column["first_id"][row]), int(column["first_tag"][row]), *stretch))
            if found:
                first_id, first_tag, start, end, first_start = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(table[name].combine_chunks().take(pa.array(owners)) for name in PAIR[:2]),
                        pa.array(first_id, type=pa.int64()), pa.array(first_tag, type=pa.int32()),
                        pa.array([[s, e - K] for s, e in zip(start, end)], type=pa.list_(pa.int32())),
                        pa.array([[f, f + e - s - K] for s, e, f in zip(start, end, first_start)],
                                 type=pa.list_(pa.int32())),
                    ],
                    [*PAIR, "pos", "first_pos"],
                )

    return rows.repartition("doc_id", "tag").sortWithinPartitions("doc_id", "tag").mapInArrow(
        run, "doc_id long, tag int, first_id long, first_tag int, pos array<int>, first_pos array<int>"
    )


def equal_runs(number: np.ndarray, column: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    """Windows (``rows`` of ``column``) that go on from each other, in the same two documents,
    as one: its first row, start, end and first_start; by document, then by start, the longest first."""
    shift = column["pos"] - column["first_pos"]
    line = (number, column["first_id"], column["first_tag"], shift)
    rows = rows[np.lexsort((column["pos"][rows], *(values[rows] for values in reversed(line))))]
    pos, new = column["pos"][rows], np.ones(len(rows), dtype=bool)
    new[1:] = np.diff(pos) > LEAST
    for values in line:
        new[1:] |= np.diff(values[rows]) != 0
    first = np.flatnonzero(new)
    end = pos[np.append(first[1:], len(rows))[: len(first)] - 1] + LEAST
    rows, start = rows[first], pos[first]
    order = np.lexsort((-end, start, number[rows]))
    return {
        "row": rows[order], "start": start[order], "end": end[order], "first_start": column["first_pos"][rows][order],
    }


def cover(runs: list[tuple], before: list[tuple]) -> list[tuple]:
    """The ``runs`` (row, start, end, first_start), as few as cover each word that is in any and
    in no passage found ``before`` (start, end); both sorted by start."""
    kept, best, reach, covered, i = [], None, -1, -1, 0
    for run in runs:
        _, start, end, _ = run
        while i < len(before) and before[i][0] <= start:
            covered = max(covered, before[i][1])
            i += 1
        if end <= max(covered, reach):
            continue
        if best is not None and start > reach:
            kept.append(best)
            reach, best = best[2], None
        if end > reach and (best is None or end > best[2]):
            best = run
    return [*kept, best] if best is not None else kept


def passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word, first_doc_id, first_start, first_end and similarity of
    passages that an earlier document (smaller id) has too."""
    spark = docs.sparkSession
    paths = [f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}" for name in ("seeds", "shared", "marked")]
    try:
        shared = stored(shared_seeds(stored(seeds(docs), paths[0])), paths[1])
        discard(spark, paths[0])
        direct = written(aligned(docs, chained(matches(shared))))
        rows = stored(marked(shared, direct), paths[2])
        discard(spark, paths[1])
        asked = written(asked_keys(rows))
        linked = written(aligned(docs, chained(linked_matches(asked))))
        accepted = direct.union(linked)
        late = written(aligned(docs, uncovered(written(open_windows(docs, asked)), accepted)))
    finally:
        for path in paths:
            discard(spark, path)
    return accepted.union(late).drop("tag")


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(read(spark, sf_dir, "documents")).distinct()
