"""Phrase collocation mining: pairs of frequency-ranked ids counted in direct-address tiles.

Texts are cut at sentence marks and line ends into pieces and those into words.  Words are
counted first, and the most frequent of all languages, WORDS_MOST at most, get ids by rank
in their language.  Pairs of ids then fall into tiles of TILE by TILE: a tile with many pairs
is counted by a dense bincount over its cells, the pairs of all other tiles by sorting their
coordinates.  Frequent pairs get ids by rank in turn, and pairs of such an id and a word's are
counted in the same way, which gives phrases of one word more, and so on.

A frequent word or phrase beyond the ranked ones has no id in the tables that tasks get.  It
is known to tasks by a bit of a filter of fixed size, and phrases with such a part are counted
by their text; what the filter lets through by chance is counted too and drops out by its
count.  So tables sent to tasks are bounded and no phrase is lost.  A phrase with an
infrequent part cannot be frequent and is not counted.  Tasks add up their own counts before
anything is shuffled, and no language is gathered in one place: the last ranking takes the
first rows of a language from each task.

Defined cases: a null text counts as empty, a null lang as ``und``.  Rows without words give
nothing; an empty table gives no rows.  Repeated rows count each.  A-Z are lower-cased, all else
is left as it is.  Of phrases tied in score and count the one that is first by UTF-8 bytes comes
first.  Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, query, read, utf8, written

LONGEST, LEAST, SHARE, TOP = 3, 10, 50, 2000
RIGHT_BITS, LEFT_BITS = 18, 20  # of a code: words and phrases that can be ranked
WORDS_MOST, WORD_BYTES = 1 << 17, 64  # ranked words, and the bytes of one
PHRASES_MOST = 1 << 18  # ranked phrases of each length
TILE = 256
DENSE = TILE * TILE // 8  # pairs from which a tile is counted densely
CHUNK = 1 << 19  # words whose pairs are counted together
FILTER_BITS = 25
SLICES = 256  # parts of a language that are ranked on their own first
BREAK, RARE = b".", -1
MIX = np.uint64(0x9E3779B97F4A7C15)
# The marks at which pieces end.
MARKS = b".,;:!?\n\x0b\x0c\r"
TO_BREAK = bytes.maketrans(MARKS, BREAK * len(MARKS))


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, with BREAK between pieces."""
    # Only blanks and tabs are left for split() to cut at.
    return text.lower().translate(TO_BREAK).replace(BREAK, b" . ").split()


# ---------------------------------------------------------------- tiles


def pair_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (left, right) of ids and their counts."""
    if not len(left):
        return left, right, np.empty(0, dtype=np.int64)
    across = int(right.max()) // TILE + 1
    tile = left // TILE * across + right // TILE
    cell = left % TILE * TILE + right % TILE
    order = np.argsort(tile, kind="stable")
    tile, cell = tile[order], cell[order]
    starts = np.flatnonzero(np.diff(tile, prepend=-1))
    sizes = np.diff(starts, append=len(tile))
    found = []
    for start, size in zip(starts[sizes >= DENSE].tolist(), sizes[sizes >= DENSE].tolist()):
        cells = np.bincount(cell[start : start + size], minlength=TILE * TILE)
        used = np.flatnonzero(cells)
        found.append((tile[start] * (TILE * TILE) + used, cells[used]))
    sparse = np.repeat(sizes < DENSE, sizes)
    found.append(np.unique(tile[sparse] * (TILE * TILE) + cell[sparse], return_counts=True))
    codes, counts = (np.concatenate(part) for part in zip(*found))
    tile, cell = codes // (TILE * TILE), codes % (TILE * TILE)
    return tile // across * TILE + cell // TILE, tile % across * TILE + cell % TILE, counts


# ---------------------------------------------------------------- what tasks know


def bit_of(lang: str, phrase: bytes, bits: int) -> int:
    return xxhash.xxh64_intdigest(phrase, xxhash.xxh64_intdigest(lang.encode(), 1)) >> (64 - bits)


def bits_of(codes: np.ndarray, bits: int) -> np.ndarray:
    """As :func:`bit_of`, for phrases whose parts have ranks."""
    mixed = codes.astype(np.uint64) * MIX
    return ((mixed ^ (mixed >> np.uint64(32))) * MIX >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Filter:
    """One bit for each frequent phrase without a rank, 64 of them in a word."""

    bits: int
    words: np.ndarray | None

    def holds(self, lang: str, phrase: bytes) -> bool:
        bit = bit_of(lang, phrase, self.bits)
        return bool((int(self.words[bit >> 6]) >> (bit & 63)) & 1)

    def holds_codes(self, codes: np.ndarray) -> np.ndarray:
        at = bits_of(codes, self.bits)
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


def coded(lang: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (lang << (LEFT_BITS + RIGHT_BITS)) | (left << RIGHT_BITS) | right


@dataclass
class Ranked:
    """Ranks within a language: of words, and for each further length of pairs (rank of all
    words but the last, rank of the last), as sorted codes and their ranks.  ``filters`` has
    one filter for each length."""

    langs: list[str]
    words: list[list[bytes]]
    filters: list[Filter] = field(default_factory=list)
    pairs: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def rank(self, lang: int, length: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of phrases of ``length`` words; RARE where one or its parts have none."""
        codes, ranks = self.pairs[length - 2]
        if not len(codes):
            return np.full(len(left), RARE)
        wanted = np.where((left >= 0) & (right >= 0), coded(lang, left, right), RARE)
        at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        return np.where(codes[at] == wanted, ranks[at], RARE)

    def texts(self, lang: int, length: int) -> list[bytes]:
        """The ranked phrases of a length by rank."""
        if length == 1:
            return self.words[lang]
        codes, ranks = self.pairs[length - 2]
        low, high = np.searchsorted(codes, [lang << (LEFT_BITS + RIGHT_BITS), (lang + 1) << (LEFT_BITS + RIGHT_BITS)])
        mine = codes[low:high][np.argsort(ranks[low:high])]
        before = self.texts(lang, length - 1)
        left, right = (mine >> RIGHT_BITS) & ((1 << LEFT_BITS) - 1), mine & ((1 << RIGHT_BITS) - 1)
        return [before[a] + b" " + self.words[lang][b] for a, b in zip(left.tolist(), right.tolist())]


class Ids(dict):
    """Numbers of the words of a chunk: ranks, then numbers of frequent words without one."""

    def __init__(self, lang: str, words: list[bytes], known: Filter):
        super().__init__(zip(words, range(len(words))))
        self.lang, self.known, self.next = lang, known, len(words)
        self[BREAK] = RARE

    def __missing__(self, word: bytes) -> int:
        number = RARE
        if self.known.words is not None and self.known.holds(self.lang, word):
            number, self.next = self.next, self.next + 1
        self[word] = number
        return number


# ---------------------------------------------------------------- counting


def by_language(langs: pa.Array, texts: pa.Array) -> Iterator[tuple[str, list[bytes]]]:
    """Chunks of the words of texts of one language; each text ends with BREAK."""
    held: dict[str, list[bytes]] = {}
    total = 0
    for lang, text in zip(langs.to_pylist(), utf8(texts)):
        if found := tokens(text):
            words = held.setdefault(lang, [])
            words += found
            words.append(BREAK)
            total += len(found)
        if total > CHUNK:
            yield from held.items()
            held, total = {}, 0
    yield from held.items()


def inputs(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.col("text")]


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """lang, phrase and f of every word that comes ``least`` times, and per language a row
    without phrase for all others."""

    def run(langs, texts):
        for lang, words in by_language(langs, texts):
            counts = Counter(words)
            del counts[BREAK]
            names = pa.array(list(counts), type=pa.binary()).cast(pa.string())
            yield [[lang] * len(counts), names, list(counts.values())]

    found = map_columns(docs, run, "lang string, phrase string, f long", *inputs(docs))
    sums = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    named = F.when(F.col("f") >= least, F.col("phrase")).alias("phrase")
    return sums.groupBy("lang", named).agg(F.sum("f").alias("f"))


def chunk_counts(
    ranked: Ranked, lang: str, words: list[bytes], length: int
) -> tuple[np.ndarray, np.ndarray, list[bytes], list[int]]:
    """Codes and counts of the phrases whose parts have ranks, texts and counts of others."""
    place = ranked.langs.index(lang) if lang in ranked.langs else RARE
    known = ranked.words[place] if place >= 0 else []
    ids = Ids(lang, known, ranked.filters[0])
    numbers = np.array(list(map(ids.__getitem__, words)), dtype=np.int64)
    # At each place, the rank of the phrase of so many words that starts there, and a number
    # that equal phrases of the chunk share; RARE where it is not frequent.
    one = np.where(numbers < len(known), numbers, RARE)
    ranks, part = one, numbers

    def codes(n: int, at: np.ndarray) -> np.ndarray:
        return part[at] * ids.next + numbers[at + n - 1]

    def both_parts(n: int) -> np.ndarray:
        ends = len(numbers) - n + 1
        return (part[:ends] >= 0) & (part[1 : ends + 1] >= 0) if ends > 0 else np.empty(0, dtype=bool)

    for n in range(2, length):
        kept = both_parts(n)
        left, right = ranks[: len(kept)], one[n - 1 :][: len(kept)]
        ranks = ranked.rank(place, n, left, right)
        unsure = np.flatnonzero(kept & (ranks < 0))
        kept &= ranks >= 0
        if ranked.filters[n - 1].words is not None:
            direct = (left[unsure] >= 0) & (right[unsure] >= 0)
            at = unsure[direct]
            kept[at] = ranked.filters[n - 1].holds_codes(coded(place, left[at], right[at]))
            unsure = unsure[~direct]
            _, first, which = np.unique(codes(n, unsure), return_index=True, return_inverse=True)
            holds = np.array(
                [ranked.filters[n - 1].holds(lang, b" ".join(words[i : i + n])) for i in unsure[first].tolist()], dtype=bool
            )
            kept[unsure[holds[which]]] = True
        at = np.flatnonzero(kept)
        _, dense = np.unique(codes(n, at), return_inverse=True)
        part = np.full(len(kept), RARE)
        part[at] = dense

    kept = both_parts(length)
    left, right = ranks[: len(kept)], one[length - 1 :][: len(kept)]
    direct = kept & (left >= 0) & (right >= 0)
    a, b, counts = pair_counts(left[direct], right[direct])
    rest = np.flatnonzero(kept & ~direct)
    _, first, others = np.unique(codes(length, rest), return_index=True, return_counts=True)
    texts = [b" ".join(words[i : i + length]) for i in rest[first].tolist()]
    return coded(place, a, b), counts, texts, others.tolist()


def phrase_counts(docs: DataFrame, ranked: Ranked, length: int, least: int) -> DataFrame:
    """code (null without one), lang, phrase and f of the phrases of ``length`` words that come
    at least ``least`` times."""
    shared = docs.sparkSession.sparkContext.broadcast(ranked)

    def run(langs, texts):
        for lang, words in by_language(langs, texts):
            codes, counts, phrases, others = chunk_counts(shared.value, lang, words, length)
            n = len(codes)
            yield [codes, pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), counts]
            n = len(phrases)
            names = pa.array(phrases, type=pa.binary()).cast(pa.string())
            yield [pa.nulls(n, pa.int64()), [lang] * n, names, others]

    def named(codes, langs, phrases, counts):
        ranked, texts = shared.value, {}
        langs, phrases = langs.to_pylist(), phrases.to_pylist()
        for row, code in enumerate(codes.to_pylist()):
            if code is not None:
                lang = code >> (LEFT_BITS + RIGHT_BITS)
                if lang not in texts:
                    texts[lang] = ranked.texts(lang, length - 1)
                left, right = (code >> RIGHT_BITS) & ((1 << LEFT_BITS) - 1), code & ((1 << RIGHT_BITS) - 1)
                langs[row] = ranked.langs[lang]
                phrases[row] = (texts[lang][left] + b" " + ranked.words[lang][right]).decode()
        yield [codes, langs, phrases, counts]

    schema = "code long, lang string, phrase string, f long"
    found = map_columns(docs, run, schema, *inputs(docs))
    sums = found.groupBy("code", "lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return map_columns(sums, named, schema, *(F.col(c) for c in ("code", "lang", "phrase", "f")))


# ---------------------------------------------------------------- ranking


def filter_of(rest: DataFrame, bits: int) -> Filter:
    """The filter of the rows (lang, phrase, code) of ``rest``; at most 2^bits bits reach the
    driver."""

    def placed(langs, phrases, codes):
        by_text = [bit_of(lang, phrase, bits) for lang, phrase in zip(langs.to_pylist(), utf8(phrases))]
        known = codes.is_valid().to_numpy(zero_copy_only=False)
        found = np.where(known, bits_of(codes.fill_null(0).to_numpy(), bits), np.array(by_text, dtype=np.int64))
        yield [found >> 6, (np.uint64(1) << (found & 63).astype(np.uint64)).view(np.int64)]

    rows = map_columns(rest, placed, "place long, mask long", F.col("lang"), F.col("phrase"), F.col("code"))
    table = rows.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    if not table.num_rows:
        return Filter(bits, None)
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[table["place"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return Filter(bits, words)


def first_rows(rows: DataFrame, can: Column, keys: list[str], most: int) -> tuple[pa.Table, DataFrame]:
    """The ``most`` most frequent of the rows that can be ranked, and all other rows."""
    order = [F.desc("f"), *keys]
    taken = rows.where(can).select(*keys, "f").orderBy(*order).limit(most).toArrow()
    if taken.num_rows < most:
        return taken, rows.where(~can)
    last = taken.slice(most - 1).to_pylist()[0]
    after, same = F.lit(False), F.lit(True)
    for name, below in (("f", F.col("f") < last["f"]), *((k, F.col(k) > F.lit(last[k])) for k in keys)):
        after, same = after | (same & below), same & (F.col(name) == F.lit(last[name]))
    return taken, rows.where(~can | after)


def ranked_words(frequent: DataFrame, most: int, bits: int) -> Ranked:
    taken, rest = first_rows(frequent, F.octet_length("phrase") <= WORD_BYTES, ["lang", "phrase"], most)
    ranked = Ranked([], [])
    places: dict[str, int] = {}
    for lang, word in zip(taken["lang"].to_pylist(), taken["phrase"].to_pylist()):
        if lang not in places:
            places[lang] = len(places)
            ranked.langs.append(lang)
            ranked.words.append([])
        ranked.words[places[lang]].append(word.encode())
    ranked.filters.append(filter_of(rest, bits))
    return ranked


def rank_pairs(ranked: Ranked, frequent: DataFrame, most: int, bits: int) -> None:
    """Add ranks of the phrases of one word more."""
    taken, rest = first_rows(frequent, F.col("code").isNotNull(), ["code"], most)
    codes = taken["code"].to_numpy()
    langs = codes >> (LEFT_BITS + RIGHT_BITS)
    order = np.argsort(langs, kind="stable")  # by language, the most frequent first
    _, firsts, sizes = np.unique(langs[order], return_index=True, return_counts=True)
    ranks = np.empty(len(codes), dtype=np.int64)
    ranks[order] = np.arange(len(codes)) - np.repeat(firsts, sizes)
    by_code = np.argsort(codes)
    ranked.pairs.append((codes[by_code], ranks[by_code]))
    ranked.filters.append(filter_of(rest, bits))


def frequencies(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST,
    words_most: int = WORDS_MOST, phrases_most: int = PHRASES_MOST, filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, size (words) and f of all phrases of at most ``longest`` words that come
    at least ``least`` times; and lang, n: how many words each language has."""
    if words_most > 1 << RIGHT_BITS or phrases_most > 1 << LEFT_BITS:
        raise ValueError("more ranks than a code can hold")
    words = written(word_counts(docs, least))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("phrase").isNotNull()).withColumn("code", F.lit(None).cast("long"))
    ranked = ranked_words(frequent, words_most, filter_bits)
    found = frequent.select("lang", "phrase", F.lit(1).alias("size"), "f")
    for size in range(2, longest + 1):
        phrases = written(phrase_counts(docs, ranked, size, least))
        found = found.union(phrases.select("lang", "phrase", F.lit(size).alias("size"), "f"))
        if size < longest:
            rank_pairs(ranked, phrases, phrases_most, filter_bits)
    return found, totals


# ---------------------------------------------------------------- scores


def exact_score(a: str, l: str, r: str) -> Column:
    """floor(1000000 a a / (l r)): products have up to 38 digits, the quotient 7."""
    a, l, r = (f"CAST({name} AS DECIMAL(16,0))" for name in (a, l, r))
    return F.expr(f"{a} * {a} * 1000000 div ({l} * {r})")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP, **limits: int
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language."""
    found, totals = frequencies(docs, longest, least, **limits)
    phrases = found.where("size > 1").withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " "))

    def of(first: Column | int, size: Column) -> Column:
        return F.array_join(F.slice("words", first, size), " ")

    cut = F.col("cut")
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "cut", of(1, cut).alias("_first"), of(cut + 1, F.col("size") - cut).alias("_rest")
    )
    for part, name in (("_first", "l"), ("_rest", "r")):
        counts = found.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        cuts = cuts.join(counts, ["lang", part])
    scored = cuts.withColumn("score", exact_score("a", "l", "r")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best")
    )

    inside = phrases.where("size > 2").select(
        "lang", "a", "words", F.explode(F.expr("sequence(2, size - 1)")).alias("n"), "size"
    ).withColumn("start", F.explode(F.expr("sequence(1, size - n + 1)")))
    longer = inside.select("lang", of(F.col("start"), F.col("n")).alias("phrase"), F.col("a").alias("longer"))
    # Written, so that the join can split partitions.
    longer = written(longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))
    ).select("lang", "phrase", "a", "best.l", "best.r", "best.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    for keys in (["lang", "slice"], ["lang"]):
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long")
        sliced = sliced.withColumn("rank", rank).where(F.col("rank") <= top)
    return sliced.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query(
    "op13_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), numbered AS (
        SELECT row_number() OVER () AS id, lang, regexp_split_to_array(piece, '[\x20\x09]+') AS w FROM pieces
    ), placed AS (
        SELECT id, lang, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM numbered
    ), words AS MATERIALIZED (
        SELECT lang, w, lead(w) OVER g AS w2, lead(w, 2) OVER g AS w3 FROM placed WHERE w <> ''
        WINDOW g AS (PARTITION BY id ORDER BY i)
    ), counts AS MATERIALIZED (
        SELECT lang, 1 AS size, w AS phrase, count(*) AS f FROM words GROUP BY ALL HAVING f >= 10
        UNION ALL
        SELECT lang, 2, w || ' ' || w2 AS phrase, count(*) AS f FROM words WHERE w2 IS NOT NULL GROUP BY ALL HAVING f >= 10
        UNION ALL
        SELECT lang, 3, w || ' ' || w2 || ' ' || w3 AS phrase, count(*) AS f FROM words WHERE w3 IS NOT NULL
        GROUP BY ALL HAVING f >= 10
    ), totals AS (
        SELECT lang, count(*) AS n FROM words GROUP BY lang
    ), candidates AS (
        SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w FROM counts WHERE size > 1
    ), parted AS MATERIALIZED (
        SELECT *, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
        FROM candidates JOIN range(1, 3) t(k) ON k < size
    ), headed AS MATERIALIZED (
        SELECT p.*, x.f AS l FROM parted p JOIN counts x ON x.lang = p.lang AND x.phrase = p.first
    ), cuts AS (
        SELECT p.lang, p.phrase, a, l, y.f AS r, ((1000000::HUGEINT * a * a) // (l::HUGEINT * y.f))::BIGINT AS score
        FROM headed p JOIN counts y ON y.lang = p.lang AND y.phrase = p.rest
        QUALIFY row_number() OVER (PARTITION BY p.lang, p.phrase ORDER BY score, k) = 1
    ), longer AS (
        SELECT lang, phrase, max(a) AS longer FROM (
            SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
            FROM candidates WHERE size = 3) GROUP BY ALL
    ), kept AS (
        SELECT cuts.* FROM cuts LEFT JOIN longer USING (lang, phrase)
        WHERE longer IS NULL OR 100 * longer < 50 * a
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score
    FROM kept JOIN totals USING (lang)
    QUALIFY rank <= 2000
    """,
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))
