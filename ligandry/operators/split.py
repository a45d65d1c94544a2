"""Train, validation and test splits by unit, and the measures of a split report."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.window import Window

#: Units beyond which all-pairs work must be asked for.
MAX_UNITS = 10_000


def units(df: DataFrame, key: str, order: Column) -> DataFrame:
    """unit, pos (in order of first appearance, from 0), size. Null and empty keys are no units."""
    found = df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(F.col(key).alias("unit")).agg(F.min(order).alias("first"), F.count("*").alias("size"))
    return found.select("unit", (F.row_number().over(Window.orderBy("first", "unit")) - 1).alias("pos"), "size")


def greedy_fill(ordered: DataFrame, rank: Column, total: int, test_ratio: float = 0.1, val_ratio: float = 0.1) -> DataFrame:
    """Add split: units in rank order go to test until it is full, then to val, the rest to train."""
    if not (0 < test_ratio < 1 and 0 < val_ratio < 1 and test_ratio + val_ratio < 1):
        raise ValueError("ratios must lie between 0 and 1 and sum to less than 1")
    t, v = max(1, round(total * test_ratio)), max(1, round(total * val_ratio))
    run = Window.orderBy(rank)
    filled = ordered.withColumn("_before", F.coalesce(F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    filled = filled.withColumn("_test", F.max(F.when(F.col("_before") < t, F.col("_before") + F.col("size"))).over(Window.partitionBy()))
    label = F.when(F.col("_before") < t, "test").when(F.col("_before") - F.col("_test") < v, "val").otherwise("train")
    return filled.withColumn("split", label).drop("_before", "_test")


def random_ranks(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """pos, rank: the place of each unit in a seeded permutation; n is checked by the caller."""
    places = np.argsort(np.random.default_rng(seed).permutation(n))
    return df.sparkSession.createDataFrame([(i, int(r)) for i, r in enumerate(places)], "pos long, rank long")


def isolation_ranks(scores: DataFrame, pos: str = "pos") -> DataFrame:
    """rank of each unit for greedy_fill: the most isolated first, of equal ones the later unit."""
    return scores.withColumn("rank", F.struct(-F.col("score"), -F.col(pos)))


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    """A 0/1 matrix of the packed words, a row for each unit."""
    words = column.combine_chunks().flatten().to_numpy().astype(np.int64).reshape(len(column), -1)
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1).astype(np.float32)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """1 - Tanimoto of each row of x to each of y, both of 0 and 1; 1 where neither has a bit."""
    both = x @ y.T
    either = x.sum(1)[:, None] + y.sum(1) - both
    shared = np.divide(both, np.maximum(either, 1, out=either), dtype=np.float64)
    return np.subtract(1, shared, out=shared)


#: Units of a block: two blocks make a tile, the work on one group of rows. Of a tile's pairs ROWS x BLOCK are held at once.
BLOCK, ROWS = 4096, 256
#: The same where every pair is a row of the result, which a tile returns at once.
PAIR_BLOCK = 1024


def _tiles(units_bits: DataFrame, schema: str, each, max_units: int | None, extra: tuple[str, ...] = (), block: int = BLOCK) -> DataFrame:
    """What each(left, right) returns for each two blocks of units (a block with itself: right is None), tables of id, bits and extra.

    A unit's block follows from its id, and a tile gets its units by shuffle, so nothing is held but two blocks. Work grows
    with the square of the units, what is shuffled with that square over block; more than max_units (None: any number) are refused.
    """
    spark = units_bits.sparkSession
    rows = units_bits.where("bits IS NOT NULL").select("id", "bits", *extra)
    n, least, most = rows.agg(F.count("*"), F.min(F.size("bits")), F.max(F.size("bits"))).first()
    if max_units is not None and n > max_units:
        raise ValueError(f"more than {max_units} units make too many pairs")
    if least != most:
        raise ValueError("fingerprints differ in length")
    k = max(1, -(-n // block))
    own = F.pmod(F.xxhash64("id"), F.lit(k)).cast("int")
    dealt = rows.select("*", own.alias("_own"), F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_other"))
    dealt = dealt.withColumn("_i", F.least("_own", "_other")).withColumn("_j", F.greatest("_own", "_other")).drop("_other")
    kind = to_arrow_schema(_parse_datatype_string(schema))

    def tile(key: tuple, held: pa.Table) -> pa.Table:
        i, j = (x.as_py() for x in key)
        left = held.filter(pc.equal(held["_own"], i))
        columns = each(left, held.filter(pc.equal(held["_own"], j)) if i < j else None)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], names=kind.names)

    parts = min(k * (k + 1) // 2, 32 * spark.sparkContext.defaultParallelism)
    return dealt.repartition(parts, "_i", "_j").groupBy("_i", "_j").applyInArrow(tile, schema)


def _ids(units: pa.Table) -> np.ndarray:
    return units["id"].to_numpy()


def pairs(units_bits: DataFrame, max_units: int | None = MAX_UNITS) -> DataFrame:
    """a, b, distance of all pairs a < b of (id long, bits). Quadratic, so more than max_units (None: any number) are refused."""

    def each(left, right):
        x, bits = _ids(left), _unpacked(left["bits"])
        if right is None:
            i, j = np.nonzero(x[:, None] < x)
            return x[i], x[j], distances(bits, bits)[i, j]
        y = _ids(right)
        return np.minimum.outer(x, y).ravel(), np.maximum.outer(x, y).ravel(), distances(bits, _unpacked(right["bits"])).ravel()

    return _tiles(units_bits, "a long, b long, distance double", each, max_units, block=PAIR_BLOCK)


def isolation(units_bits: DataFrame, max_units: int | None = MAX_UNITS) -> DataFrame:
    """id, score of units (id long, bits, size): mean distance to all other molecules, weighted by unit size; 0 for a unit alone."""

    def each(left, right):
        other = left if right is None else right
        x, bits, size = _ids(left), _unpacked(left["bits"]), left["size"].to_numpy().astype(np.float64)
        y, other_bits, other_size = _ids(other), _unpacked(other["bits"]), other["size"].to_numpy().astype(np.float64)
        far, rest, back = np.zeros(len(x)), np.full(len(x), other_size.sum()), np.zeros(len(y))
        for a in range(0, len(x), ROWS):
            here = slice(a, a + ROWS)
            d = distances(bits[here], other_bits)
            if right is None:
                same = x[here, None] == y
                d[same] = 0
                rest[here] -= same @ other_size
            else:
                back += size[here] @ d
            far[here] = d @ other_size
        if right is None:
            return x, far, rest
        return np.concatenate([x, y]), np.concatenate([far, back]), np.concatenate([rest, np.full(len(y), size.sum())])

    parts = _tiles(units_bits, "id long, far double, rest double", each, max_units, ("size",))
    found = parts.groupBy("id").agg(F.sum("far").alias("far"), F.sum("rest").alias("rest"))
    return found.select("id", F.when(F.col("rest") > 0, F.col("far") / F.col("rest")).otherwise(0.0).alias("score"))


def nearest(units_bits: DataFrame, max_units: int | None = MAX_UNITS) -> DataFrame:
    """id, query, reference, d of rows (id long, bits, split): the distance to the nearest other row of each split."""

    def ordered(units):
        units = units.sort_by("split")
        names, first = np.unique(np.array(units["split"].to_pylist(), object), return_index=True)
        return _ids(units), _unpacked(units["bits"]), names, [slice(a, b) for a, b in zip(first, [*first[1:], len(units)])]

    def listed(ids, own, spans, names, least):
        i, k = np.nonzero(np.isfinite(least))
        query = np.repeat(own, [s.stop - s.start for s in spans])
        return ids[i], query[i], names[k], least[i, k]

    def each(left, right):
        x, bits, names, spans = ordered(left)
        y, other_bits, other_names, other_spans = ordered(right) if right is not None else (x, bits, names, spans)
        least, back = np.full((len(x), len(other_names)), np.inf), np.full((len(y), len(names)), np.inf)
        for k, span in enumerate(spans):
            for a in range(span.start, span.stop, ROWS):
                here = slice(a, min(a + ROWS, span.stop))
                d = distances(bits[here], other_bits)
                if right is None:
                    d[x[here, None] == y] = np.inf
                else:
                    np.minimum(back[:, k], d.min(0, initial=np.inf), out=back[:, k])
                for m, other in enumerate(other_spans):
                    least[here, m] = d[:, other].min(1)
        found = listed(x, names, spans, other_names, least)
        if right is None:
            return found
        return [np.concatenate(c) for c in zip(found, listed(y, other_names, other_spans, names, back))]

    parts = _tiles(units_bits, "id long, query string, reference string, d double", each, max_units, ("split",))
    return parts.groupBy("id", "query", "reference").agg(F.min("d").alias("d"))


def nearest_summary(units_bits: DataFrame, max_units: int | None = MAX_UNITS) -> DataFrame:
    """For each pair of splits: how far the rows of the first are from their nearest one in the second."""
    found = nearest(units_bits, max_units)
    return found.groupBy("query", "reference").agg(F.avg("d").alias("mean"), F.percentile("d", 0.5).alias("median"), F.percentile("d", 0.1).alias("p10"), F.percentile("d", 0.9).alias("p90"), F.count("*").alias("n"))


def fingerprint_qc(df: DataFrame, bits: str = "bits") -> DataFrame:
    """Rows of each split with and without a fingerprint."""
    return df.groupBy("split").agg(F.count("*").alias("n_total"), F.count(bits).alias("n_valid"), F.count_if(F.col(bits).isNull()).alias("n_failed"))


def composition(df: DataFrame) -> DataFrame:
    total = df.agg(F.count("*").alias("total"))
    return df.groupBy("split").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select("split", "n", F.bround(F.col("n") / F.col("total"), 4).alias("ratio"))


def scaffold_stats(df: DataFrame, scaffold: str = "scaffold") -> DataFrame:
    """Per split: scaffolds, singletons and their share, and entropy scaled to 0..1 (null below two scaffolds)."""
    counted = df.where(F.col(scaffold).isNotNull()).groupBy("split", scaffold).agg(F.count("*").alias("n"))
    total = counted.groupBy("split").agg(F.sum("n").alias("rows"), F.count("*").alias("n_scaffolds"), F.count_if(F.col("n") == 1).alias("n_singletons"), F.sum(F.col("n") * F.log2("n")).alias("nlogn"))
    entropy = F.when(F.col("n_scaffolds") > 1, (F.log2("rows") - F.col("nlogn") / F.col("rows")) / F.log2("n_scaffolds"))  # sum of -p log2 p in one pass
    return total.select("split", "n_scaffolds", "n_singletons", F.round(F.col("n_singletons") / F.col("n_scaffolds"), 6).alias("singleton_fraction"), F.round(entropy, 6).alias("entropy"))


def scaffold_overlap(df: DataFrame, scaffold: str = "scaffold") -> DataFrame:
    seen = df.where(F.col(scaffold).isNotNull()).groupBy(scaffold).agg(*[F.max((F.col("split") == s).cast("int")).alias(s) for s in ("train", "val", "test")])
    both = lambda a, b: F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"{a}_{b}")
    return seen.agg(both("test", "train"), both("val", "train"), both("test", "val"))


def retrieval_curve(df: DataFrame, scaffold: str = "scaffold") -> DataFrame:
    """rank of each scaffold by size, and rows in it and all larger ones."""
    counted = df.groupBy(scaffold).agg(F.count("*").alias("n"))
    order = Window.orderBy(F.desc("n"), scaffold)
    return counted.select(scaffold, "n", F.row_number().over(order).alias("rank"), F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative"))


def activity_summary(df: DataFrame, value: str) -> DataFrame:
    c = F.col(value).try_cast("double")
    return df.groupBy("split").agg(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.count(c).alias("n"))


def ks_statistic(df: DataFrame, value: str, a: str = "train", b: str = "test") -> DataFrame:
    """Largest difference of the two distribution functions; null if a side has fewer than two values.

    Values are counted first; the running counts then need one sorted pass over distinct values, in range slices whose
    totals are added up from a row each.
    """
    c = F.col(value).try_cast("double")
    counted = df.where(F.col("split").isin(a, b) & c.isNotNull()).groupBy(c.alias("v")).agg(F.count_if(F.col("split") == a).alias("na"), F.count_if(F.col("split") == b).alias("nb"))
    sliced = counted.withColumn("slice", F.floor(F.col("v") * 8))
    totals = sliced.groupBy("slice").agg(F.sum("na").alias("ta"), F.sum("nb").alias("tb"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = totals.select("slice", F.coalesce(F.sum("ta").over(before), F.lit(0)).alias("oa"), F.coalesce(F.sum("tb").over(before), F.lit(0)).alias("ob"), F.sum("ta").over(whole).alias("all_a"), F.sum("tb").over(whole).alias("all_b"))
    run = Window.partitionBy("slice").orderBy("v")
    stepped = sliced.select("slice", F.sum("na").over(run).alias("ra"), F.sum("nb").over(run).alias("rb")).join(offsets, "slice")
    gap = F.max(F.abs((F.col("oa") + F.col("ra")) / F.col("all_a") - (F.col("ob") + F.col("rb")) / F.col("all_b")))
    enough = (F.max("all_a") > 1) & (F.max("all_b") > 1)
    return stepped.agg(F.when(enough, gap).alias("statistic"), F.max("all_a").alias("n_a"), F.max("all_b").alias("n_b"))


def ks_p_value(statistic: float, n: int, m: int) -> float:
    """Asymptotic two-sided p-value of the two-sample statistic."""
    x = statistic * math.sqrt(n * m / (n + m))
    if x < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))))
