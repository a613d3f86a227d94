"""Vector code compression: integer codebooks per part, assigned through a Walsh-Hadamard transform.

Components become integers ``floor(scale * x)`` and vectors are cut into equal parts. A part and its
codebook's entries, padded with zeros to a power of two, are taken through the integer
Walsh-Hadamard transform, which multiplies every squared distance by that power and puts most of a
smooth part's difference into its first coefficients. Squared differences of coefficients are added
in sequency order (by number of sign changes); an entry whose sum passes the whole distance of a
likely entry is out. All numbers are integers, so distances, ties and entries are exact.

A round reads the vectors once: tasks assign parts and send one sum of coefficients per entry,
whatever the number of rows. The driver sees these sums alone, ``parts x entries x width`` numbers;
the transform is linear, so entries follow from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import small_batches, staged

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
SLICE = 2048  # rows compared at a time within a batch
LIMB = 40     # sums travel as limbs of so many bits, so that Spark's sums of longs stay exact


def is_whole(vector: str = "embedding") -> Column:
    """Whether a vector is given and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite, F.lit(False))


def sequency_order(n: int) -> np.ndarray:
    """Rows of the n by n Hadamard matrix by their number of sign changes."""
    at = np.arange(n)
    signs = np.array([[bin(i & j).count("1") & 1 for j in at] for i in at])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def walsh_hadamard(values: np.ndarray) -> np.ndarray:
    """The unscaled transform along the last axis, whose length is a power of two, in natural order.
    Applied twice it multiplies by that length."""
    *lead, n = values.shape
    step = 1
    while step < n:
        pairs = values.reshape(*lead, n // (2 * step), 2, step)
        low, high = pairs[..., 0, :], pairs[..., 1, :]
        values = np.stack([low + high, low - high], axis=-2).reshape(*lead, n)
        step *= 2
    return values


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per point the nearest entry (ties to the lower index) and the squared distance, both in terms
    of transformed coefficients.

    The entry closest in the first coefficient gives the bound, its whole distance. The others stay
    as long as their sum has not passed it."""
    n, width = points.shape
    partial = (points[:, :1] - entries[:, 0]) ** 2
    likely = entries[partial.argmin(axis=1)]
    bound = ((points - likely) ** 2).sum(axis=1)
    row, entry = np.nonzero(partial <= bound[:, None])
    reached = partial[row, entry]
    for place in range(1, width):
        reached = reached + (points[row, place] - entries[entry, place]) ** 2
        stay = (reached <= bound[row]).astype(bool)
        row, entry, reached = row[stay], entry[stay], reached[stay]
    everyone = np.arange(n)
    least = np.minimum.reduceat(reached, np.searchsorted(row, everyone)) if n else reached
    hit = np.flatnonzero(reached == least[row])
    first = hit[np.searchsorted(row[hit], everyone)]
    return entry[first], least


class Shape:
    """How vectors of ``dim`` components lie in parts, and the number type that is exact for them."""

    def __init__(self, dim: int, largest: float, parts: int, scale: int):
        self.dim, self.parts, self.scale = dim, parts, scale
        self.width = max(1, -(-dim // parts))
        self.padded = 1 << (self.width - 1).bit_length()
        self.order = sequency_order(self.padded)
        # coefficients stay below width * largest, scaled distances below the square of twice that
        reach = 2 * self.padded * (largest * scale + 1)
        self.kind = np.int64 if reach * reach * parts < 2.0 ** 62 else object

    def integers(self, vectors: list) -> np.ndarray:
        """``floor(scale * x)`` of rows of components, as rows by parts by width; short rows are
        filled with zeros."""
        flat = np.array([x for v in vectors for x in v], dtype=np.float64)
        return self._cut(flat, np.array([len(v) for v in vectors], dtype=np.int64))

    def column(self, column: pa.Array) -> np.ndarray:
        return self._cut(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64),
                         column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))

    def _cut(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if self.kind is np.int64:
            numbers = np.floor(flat * self.scale).astype(np.int64)
        else:
            # a number of 2**52 and above is whole, so it is multiplied as an integer
            numbers = np.array([int(x) * self.scale if abs(x) >= 2.0 ** 52 else int(np.floor(x * self.scale))
                                for x in flat.tolist()], dtype=object)
        out = np.zeros((len(lengths), self.parts * self.width), dtype=self.kind)
        out[np.arange(out.shape[1]) < lengths[:, None]] = numbers
        return out.reshape(len(lengths), self.parts, self.width)

    def coefficients(self, numbers: np.ndarray) -> np.ndarray:
        """Padded and transformed, in sequency order."""
        out = np.zeros((*numbers.shape[:-1], self.padded), dtype=self.kind)
        out[..., :self.width] = numbers
        return walsh_hadamard(out)[..., self.order]

    def mean_floor(self, sums: list[int], count: int) -> list[int]:
        """The componentwise floor of sum by count, from sums of coefficients."""
        natural = np.zeros(self.padded, dtype=object)
        natural[self.order] = sums
        return [int(x) // self.padded // count for x in walsh_hadamard(natural)[:self.width]]


def _first_entries(kept: DataFrame, entries: int) -> list:
    """Vectors of the smallest ids; of rows that share an id the smallest one. A null id is last."""
    ids = [r["vec_id"] for r in kept.select("vec_id").distinct()
           .orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    known = F.col("vec_id").isin([i for i in ids if i is not None])
    rows = kept.where(known | F.col("vec_id").isNull() if None in ids else known)
    found = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return [r["embedding"] for r in found.orderBy(F.asc_nulls_last("vec_id")).collect()]


def _round(kept: DataFrame, shape: Shape, books: np.ndarray) -> np.ndarray:
    """The entries after assigning every part and averaging: one pass over the vectors."""
    transformed = shape.coefficients(books)
    entries = books.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # per part and entry: the sum of every coefficient, then the number of parts
        total = np.zeros((shape.parts, entries, shape.padded + 1), dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                points = shape.coefficients(shape.column(batch.column("embedding").slice(at, SLICE)))
                for part in range(shape.parts):
                    own, _ = nearest(points[:, part], transformed[part])
                    member = (own == np.arange(entries)[:, None]).astype(shape.kind)
                    total[part, :, :-1] += (member @ points[:, part]).astype(object)
                    total[part, :, -1] += np.bincount(own, minlength=entries).astype(object)
        cell, limb, value = [], [], []
        for number, left in enumerate(total.ravel().tolist()):
            place = 0
            while left:
                more, rest = (0, left) if abs(left) < 1 << LIMB else divmod(left, 1 << LIMB)
                cell.append(number)
                limb.append(place)
                value.append(rest)
                left, place = more, place + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell, pa.int64()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())],
            names=["cell", "limb", "value"])

    sums = (kept.select("embedding").mapInArrow(add, "cell long, limb int, value long")
            .groupBy("cell", "limb").agg(F.sum("value").alias("value")).collect())
    total = np.zeros(shape.parts * entries * (shape.padded + 1), dtype=object)
    for r in sums:
        total[r["cell"]] += r["value"] << LIMB * r["limb"]
    out = books.copy()
    for part, book in enumerate(total.reshape(shape.parts, entries, shape.padded + 1)):
        for entry, numbers in enumerate(book):
            if numbers[-1]:
                out[part, entry] = shape.mean_floor(numbers[:-1].tolist(), int(numbers[-1]))
    return out


def _assigned(kept: DataFrame, shape: Shape, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error``: two hex digits per part; null for an error beyond 64 bits."""
    transformed = shape.coefficients(books)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for at in range(0, batch.num_rows, SLICE):
                points = shape.coefficients(shape.column(batch.column("embedding").slice(at, SLICE)))
                found = [nearest(points[:, part], transformed[part]) for part in range(shape.parts)]
                own = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
                codes += [row.tobytes().hex() for row in own]
                errors += (sum(f[1] for f in found) // shape.padded).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                 pa.array([e if e < 1 << 63 else None for e in errors], pa.int64())],
                names=["vec_id", "label", "code", "error"])

    return kept.mapInArrow(assign, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(rows: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of the rows whose vector is whole.

    ``rows`` has vec_id, embedding and label; other columns are not read. Rows whose vector is null
    or holds null, NaN or infinite components are dropped, an empty table or one without whole
    vectors gives no rows. Repeated rows count each time; the first entries come from distinct ids,
    each with its smallest vector, a null id last, and there are fewer entries where there are fewer
    ids. Vectors shorter than the longest, and a length that ``parts`` does not divide, are filled
    with zeros at the end. Components of any size stay exact; an ``error`` or ``label_error`` beyond
    64 bits is null. Rows of equal label, nulls together, share ``label_error``. ``entries`` is 256
    at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits")
    spark = rows.sparkSession
    with small_batches(spark):
        kept = staged(rows.select("vec_id", "label", "embedding").where(is_whole()), "vectors")
        size = kept.agg(F.max(F.size("embedding")).alias("dim"),
                        F.max(F.array_max(F.transform("embedding", F.abs)).cast("double")).alias("largest")).first()
        if size["dim"] is None:
            return spark.createDataFrame(
                [], f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, code string, error long, "
                    "label_error long, codebooks_sha256 string")
        shape = Shape(size["dim"], size["largest"] or 0.0, parts, scale)
        books = shape.integers(_first_entries(kept, entries)).transpose(1, 0, 2)
        for _ in range(rounds):
            books = _round(kept, shape, books)
        coded = staged(_assigned(kept, shape, books), "codes")
    digest = hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()
    by_label = coded.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"),
        F.count_if(F.col("error").isNull()).alias("beyond"))
    by_label = by_label.select(F.col("label").alias("_label"), F.when(
        F.col("beyond") == 0, F.col("sum").try_cast("long")).alias("label_error"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
