"""Vector code compression: product codes learned and assigned through value dictionaries.

Components become integers, vectors are cut into parts, and each part gets the number of the
nearest entry of its codebook.  Vectors are kept in blocks: per dimension a dictionary of the
block's distinct integers, and per vector the places of its components in them.  For a
codebook, the squared differences of every distinct integer to all entries are tabulated per
dimension; the distances of a part are then gathers from these tables by dictionary code,
added up over the part's dimensions.  All arithmetic is on integers.

Blocks are written once and read by every round.  A round returns, per entry and component,
the sums of the parts assigned to it, added up within tasks first; the driver holds the
codebooks, PARTS * ENTRIES entries, whatever the number of vectors.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor
do vectors of another length than most (of equally frequent lengths the largest).  Zero
vectors, repeated rows and rows without vec_id take part.  The first entries come from the
rows with the smallest vec_id, null last, then the smallest vector; fewer rows than entries
give fewer entries.  A length that the number of parts does not divide is cut as evenly as
can be.  Labels are compared as texts, nulls with each other.  A component beyond LARGEST
after scaling is refused with an error, since distances would need more than 64 bits.  Extra
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, query, read, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK = 1 << 14  # vectors of a block at most; dictionary codes have 16 bits
STEP = 1024  # vectors whose distances are held at once
LARGEST = 1 << 26


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label (text) and vector (array of double) of the rows that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    ).where("forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows.where(F.size("vector") == (most["length"] if most else -1))


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    scaled = np.floor(vectors * scale)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} once scaled by {scale}")
    return scaled.astype(np.int64)


def blocks(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``rows`` as of :func:`usable`, BLOCK at most to a row: ids, labels, and per dimension
    the sorted distinct integers (``sizes`` of them in ``values``) and the places in them of
    the vectors' components (``codes``, 16 bits each)."""

    def cut(ids, labels, vectors):
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
        for first in range(0, len(vectors), BLOCK):
            part = integers(flat[first : first + BLOCK], scale)
            found = [np.unique(column, return_inverse=True) for column in part.T]
            codes = np.array([code for _, code in found], dtype=np.uint16)
            yield [
                pa.array([ids.slice(first, BLOCK).to_pylist()], type=pa.list_(pa.int64())),
                pa.array([labels.slice(first, BLOCK).to_pylist()], type=pa.list_(pa.string())),
                [[len(values) for values, _ in found]],
                [np.concatenate([values for values, _ in found] or [[]]).astype(np.int64)],
                [codes.tobytes()],
            ]

    return map_columns(
        rows, cut, "ids array<long>, labels array<string>, sizes array<int>, values array<long>, codes binary",
        F.col("vec_id"), F.col("label"), F.col("vector"),
    )


@dataclass
class Codebooks:
    """``entries`` has one row per entry number with the components of all parts; dimension
    ``bounds[p]`` is the first of part p."""

    entries: np.ndarray
    bounds: list[int]

    @property
    def parts(self) -> int:
        return len(self.bounds) - 1

    def part(self, p: int) -> np.ndarray:
        return self.entries[:, self.bounds[p] : self.bounds[p + 1]]

    def digest(self) -> str:
        numbers = (str(x) for p in range(self.parts) for x in self.part(p).ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def decode(self, code: str) -> list[int]:
        """The integers that a code stands for."""
        numbers = bytes.fromhex(code)
        return [x for p in range(self.parts) for x in self.part(p)[numbers[p]].tolist()]

    def nearest(self, values: list[np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances (vectors by parts) for a block."""
        n = codes.shape[1]
        numbers = np.zeros((n, self.parts), dtype=np.int64)
        errors = np.zeros((n, self.parts), dtype=np.int64)
        for p in range(self.parts):
            low, high = self.bounds[p], self.bounds[p + 1]
            reach = max((int(np.abs(v).max()) for v in values[low:high]), default=0)
            reach += int(np.abs(self.part(p)).max(initial=0))
            kind = np.int32 if reach * reach * (high - low) < 2**31 else np.int64
            tables = [
                np.square(values[d][:, None].astype(kind) - self.entries[:, d][None, :].astype(kind))
                for d in range(low, high)
            ]
            total = np.empty((min(STEP, n), len(self.entries)), dtype=kind)
            gathered = np.empty_like(total)
            for first in range(0, n, STEP):
                rows = slice(first, min(first + STEP, n))
                size = rows.stop - first
                total[:size] = 0
                for table, d in zip(tables, range(low, high)):
                    np.take(table, codes[d, rows], axis=0, out=gathered[:size], mode="clip")
                    total[:size] += gathered[:size]
                best = total[:size].argmin(axis=1)
                numbers[rows, p] = best
                errors[rows, p] = total[np.arange(size), best]
        return numbers, errors


def unpacked(sizes: pa.Array, values: pa.Array, codes: pa.Array) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """The dictionaries and codes (dimensions by vectors) of each block."""
    for size, value, code in zip(sizes, values, codes):
        lengths = np.array(size.as_py(), dtype=np.int64)
        held = np.split(value.values.to_numpy(), np.cumsum(lengths)[:-1]) if len(lengths) else []
        yield held, np.frombuffer(code.as_py(), dtype=np.uint16).reshape(len(lengths), -1) if len(lengths) else np.empty((0, 0), np.uint16)


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> Codebooks | None:
    """The parts of the rows with the smallest ids; None without rows."""
    order = F.col("vec_id").asc_nulls_last()
    first = [row["vector"] for row in rows.orderBy(order, "vector").limit(entries).select("vector").collect()]
    if not first:
        return None
    width = len(first[0])
    return Codebooks(
        integers(np.array(first, dtype=np.float64).reshape(len(first), width), scale),
        [p * width // parts for p in range(parts + 1)],
    )


def improved(packed: DataFrame, books: Codebooks) -> Codebooks:
    """One round: entries become the floored means of the parts assigned to them."""
    count, width = books.entries.shape

    def sums(sizes, values, codes):
        # Cells: entry by dimension, then part by entry for how many were assigned.
        totals = np.zeros(count * width + books.parts * count, dtype=np.int64)
        for held, places in unpacked(sizes, values, codes):
            numbers, _ = books.nearest(held, places)
            for p in range(books.parts):
                mine = numbers[:, p]
                used = totals[count * width + p * count :][:count]
                used += np.bincount(mine, minlength=count)
                for d in range(books.bounds[p], books.bounds[p + 1]):
                    # Sums of a block are far below 2^53, so the doubles are exact.
                    added = np.bincount(mine, weights=held[d][places[d]], minlength=count)
                    totals[: count * width].reshape(count, width)[:, d] += added.astype(np.int64)
        cells = np.flatnonzero(totals)
        yield [cells, totals[cells]]

    rows = map_columns(
        packed, sums, "cell long, total long", F.col("sizes"), F.col("values"), F.col("codes")
    ).groupBy("cell").agg(F.sum("total").alias("total"))
    totals = np.zeros(count * width + books.parts * count, dtype=np.int64)
    for row in rows.collect():
        totals[row["cell"]] = row["total"]
    sums_, used = totals[: count * width].reshape(count, width), totals[count * width :].reshape(books.parts, count)
    counts = np.repeat(used.T, np.diff(books.bounds), axis=1)
    means = np.where(counts > 0, sums_ // np.maximum(counts, 1), books.entries)
    return Codebooks(means, books.bounds)


def encoded(packed: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code and error of every vector."""

    def run(ids, labels, sizes, values, codes):
        for names, marks, (held, places) in zip(ids, labels, unpacked(sizes, values, codes)):
            n = len(names)
            numbers, errors = books.nearest(held, places) if len(held) else (np.zeros((n, books.parts), int),) * 2
            text = numbers.astype(np.uint8).tobytes().hex()
            wide = 2 * books.parts
            yield [
                names.values, marks.values, [text[i * wide : (i + 1) * wide] for i in range(n)], errors.sum(axis=1),
            ]

    return map_columns(
        packed, run, "vec_id long, label string, code string, error long",
        F.col("ids"), F.col("labels"), F.col("sizes"), F.col("values"), F.col("codes"),
    )


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, Codebooks | None]:
    """The codes of all vectors (vec_id, label, code, error) and the codebooks they refer to."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits per part")
    rows = usable(vectors)
    books = first_books(rows, parts, entries, scale)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, label string, code string, error long"), None
    packed = written(blocks(rows, scale))
    for _ in range(rounds):
        books = improved(packed, books)
    return encoded(packed, books), books


# Rounds of the SQL: nearest entries, then entries from the parts assigned to them.
_NEAR = """
    near{n} AS MATERIALIZED (
        SELECT rid, p, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (
            SELECT rid, a.p, e, list_sum(list_transform(
                       range(1, len(a.c) + 1), lambda i: (a.c[i] - b.c[i]) * (a.c[i] - b.c[i])))::BIGINT AS d
            FROM parts a JOIN book{n} b ON a.p = b.p) GROUP BY rid, p
    )"""
_BOOK = """
    book{next} AS MATERIALIZED (
        SELECT p, e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN (
            SELECT p, e, list(CAST(floor(total / used) AS BIGINT) ORDER BY i) AS c FROM (
                SELECT p, e, i, sum(x) AS total, count(*) AS used FROM (
                    SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM parts JOIN near{n} USING (rid, p)
                ) GROUP BY p, e, i) GROUP BY p, e) m USING (p, e)
    )"""


@query(
    "op12_vector_codes",
    f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS rid, vec_id, label,
               list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
        SELECT rid, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS c FROM kept, range(4) t(p)
    ), book0 AS MATERIALIZED (
        SELECT p, rid AS e, c FROM parts WHERE rid < 256
    ), {",".join(_NEAR.format(n=n) + "," + _BOOK.format(n=n, next=n + 1) for n in range(ROUNDS))},
    {_NEAR.format(n=ROUNDS)}, codes AS (
        SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM near{ROUNDS} GROUP BY rid
    ), digest AS (
        SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}
    )
    SELECT vec_id, code, error,
           CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN codes USING (rid), digest
    """,
)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(read(spark, sf_dir, "embeddings"))
    codes = written(codes)
    # Written, so that the join can split the partition of a label that many rows have.
    sums = written(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest() if books else "").alias("codebooks_sha256")
    )
