"""Vector code compression: product codes, assigned through memoised grid cells.

Vectors become integers (floor of ``scale`` times the component) and are cut into ``PARTS`` consecutive
parts, each coded by the nearest of at most ``ENTRIES`` codebook entries (squared distance,
ties to the lower index).  To code a part:

* its coarse cell (components divided by the cell width) is looked up, by its
  bytes, in the task's memory;
* a new cell keeps the entries that are not *dominated* over its box: those whose
  least distance to the box does not exceed the smallest greatest distance of
  any entry.  A dominated entry is farther than some other from every point of
  the box, so it can neither win nor tie;
* only the kept entries are evaluated exactly for the part.

The memory of a task holds ``MEMO_CELLS`` cells for a codebook and then starts anew, which costs
time, never a result.  The cell width is ``CELL_SIGMAS`` times the components' standard deviation over the whole table.

Rounds: every task codes its rows and sums the parts of every entry (at most
``PARTS * ENTRIES`` rows leave it), the sums are added over tasks, and the floor of the mean replaces
every entry in use.  The driver holds the codebooks, whose size the parameters bound.

Defined results: rows whose vector is null, empty or holds a null or non-finite component are
left out, as are vectors of another length than that of the smallest kept id; parts of a length not divisible
by ``PARTS`` differ by one component; components beyond +-2**27 after scaling count as that bound;
rows of one id are ordered by their components; a null id comes last; fewer vectors than
``ENTRIES`` give as many entries; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import setup, shared_table
from ledgerflow.llm.lloyd import block_edges, exact_sum, integer_vectors

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
CELL_SIGMAS = 0.5
MEMO_CELLS = 1 << 15
#: Part-entry pairs evaluated by one array operation.
PAIRS = 1 << 18


class CellMemo:
    """Nearest entries of one codebook, through remembered grid cells."""

    def __init__(self, entries: np.ndarray, width: int):
        self.entries, self.width = entries.astype(np.int64), max(1, int(width))
        self.cells: dict[bytes, np.ndarray] = {}
        self.made = 0

    def _not_dominated(self, cells: np.ndarray) -> list[np.ndarray]:
        low = cells * self.width
        least = np.zeros((len(cells), len(self.entries)), dtype=np.int64)
        most = np.zeros_like(least)
        for i in range(cells.shape[1]):
            a = low[:, i:i + 1] - self.entries[None, :, i]  # box edge minus entry
            b = -a - (self.width - 1)  # entry minus the box's upper edge
            out = np.maximum(np.maximum(a, b), 0)
            least += out * out
            far = np.maximum(np.abs(a), np.abs(b))
            most += far * far
        keep = least <= most.min(axis=1, keepdims=True)
        return [np.flatnonzero(k).astype(np.int32) for k in keep]

    def _known(self, parts: np.ndarray) -> list[np.ndarray]:
        """The entries left for every part's cell."""
        cells = np.ascontiguousarray(parts // self.width)
        keys = [c.tobytes() for c in cells]
        new: dict[bytes, int] = {k: i for i, k in enumerate(keys) if k not in self.cells}
        if len(self.cells) + len(new) > MEMO_CELLS:
            self.cells.clear()
            new = {k: i for i, k in enumerate(keys)}
        at = list(new.values())
        self.made += len(at)
        step = max(1, PAIRS // max(1, len(self.entries)))
        for lo in range(0, len(at), step):
            some = at[lo:lo + step]
            for i, left in zip(some, self._not_dominated(cells[some])):
                self.cells[keys[i]] = left
        return [self.cells[k] for k in keys]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of every part's nearest entry."""
        index, distance = np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
        step = max(1, PAIRS // len(self.entries))
        for lo in range(0, len(parts), step):
            some = parts[lo:lo + step]
            left = self._known(some)
            count = np.array([len(x) for x in left])
            starts = np.cumsum(count) - count
            entry, row = np.concatenate(left), np.repeat(np.arange(len(some)), count)
            diff = some[row] - self.entries[entry]
            d = np.einsum("ij,ij->i", diff, diff)
            best = np.minimum.reduceat(d, starts)
            at = np.flatnonzero(d == best[row])  # entries ascend within a row: the first is the lowest
            first = np.unique(row[at], return_index=True)[1]
            index[lo:lo + step], distance[lo:lo + step] = entry[at[first]], best
        return index, distance


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column of rows of ``dim`` integers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _sums(table: DataFrame, books: list[np.ndarray], edges: list[int], width: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and componentwise sum of the parts of every entry in use."""
    dim, wide = edges[-1], max(b - a for a, b in zip(edges, edges[1:]))

    def run(batches):
        memos = [CellMemo(b, width) for b in books]
        total = [np.zeros(b.shape, dtype=np.int64) for b in books]
        count = [np.zeros(len(b), dtype=np.int64) for b in books]
        for batch in batches:
            x = _vectors(batch.column(0), dim)
            for j, memo in enumerate(memos):
                part = x[:, edges[j]:edges[j + 1]]
                code, _ = memo.nearest(part)
                np.add.at(total[j], code, part)
                count[j] += np.bincount(code, minlength=len(count[j]))
        rows = [(j, e, int(count[j][e]), np.pad(total[j][e], (0, wide - total[j].shape[1])).tolist())
                for j in range(len(books)) for e in np.flatnonzero(count[j]).tolist()]
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                                          pa.array(cols[3], pa.list_(pa.int64()))], names=["part", "entry", "n", "s"])

    got = table.select("v").mapInArrow(run, "part int, entry int, n long, s array<long>").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(wide)]).alias("s"))
    return {(r["part"], r["entry"]): (r["n"], r["s"]) for r in got.collect()}  # parts x entries rows


def fit_codebooks(table: DataFrame, edges: list[int], width: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of every part, after ``rounds`` rounds from the smallest ids' parts."""
    first = table.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.array([r["v"] for r in first], dtype=np.int64).reshape(-1, edges[-1])
    books = [start[:, a:b].copy() for a, b in zip(edges, edges[1:])]
    for _ in range(rounds if len(start) else 0):
        for (j, e), (n, s) in _sums(table, books, edges, width).items():
            books[j][e] = [x // n for x in s[:books[j].shape[1]]]
    return books


def coded(table: DataFrame, books: list[np.ndarray], edges: list[int], width: int) -> DataFrame:
    """``(id, label, code, error)`` of every row, the code in two hex digits a part."""
    dim = edges[-1]

    def run(batches):
        memos = [CellMemo(b, width) for b in books]
        for batch in batches:
            x = _vectors(batch.column(2), dim)
            codes, errors = np.zeros((len(x), len(memos)), dtype=np.uint8), np.zeros(len(x), dtype=np.int64)
            for j, memo in enumerate(memos):
                code, d = memo.nearest(x[:, edges[j]:edges[j + 1]])
                codes[:, j] = code
                errors += d
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                              pa.array(errors, pa.int64())], names=["id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    return table.select("id", "label", "v").mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for e in b.tolist() for x in e).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """``(id, label, code, error)`` of every vector that counts, and the codebooks."""
    setup(vectors.sparkSession)
    chosen = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("e"), F.col(label_col).alias("label"))
    table = shared_table(integer_vectors(chosen, scale, "id", "e"), "integer-vectors")
    head = table.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).select(F.size("v").alias("dim")).first()
    if head is None:
        return table.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    dim, edges = head["dim"], block_edges(head["dim"], parts)
    table = table.where(F.size("v") == dim)
    sizes = table.select(F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("s"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x * F.lit(1.0) * x).alias("q"))
    m = sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    spread = max(0.0, m["q"] / (m["n"] * dim) - (m["s"] / (m["n"] * dim)) ** 2) ** 0.5
    width = max(1, round(CELL_SIGMAS * spread))
    books = fit_codebooks(table, edges, width, entries, rounds)
    return coded(table, books, edges, width), books


def compression_report(vectors: DataFrame, **kw) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every vector."""
    got, books = compress_vectors(vectors, **kw)
    got = shared_table(got, "codes")
    by = got.groupBy(F.col("label").alias("of")).agg(exact_sum("error").alias("label_error"))
    return got.join(by, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
