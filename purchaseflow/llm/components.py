"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from purchaseflow.sources.scratch import staged


SALTS = 16


def _lowest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``low``, the lowest of u and its neighbours v.

    The edges of a node are spread over SALTS tasks, as the centre of a star may hold a
    third of all edges. The salt also makes both sides of the join shuffles of their own,
    which Spark splits further where they are skewed.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    salted = edges.withColumn("__salt", F.pmod(F.hash("v"), F.lit(SALTS)))
    joined = salted.join(low.select("u", "low", salts), ["u", "__salt"])
    return joined.withColumn("low", F.least("u", "low")).drop("__salt")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _lowest(both).filter(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("low").alias("v")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _lowest(down)
    pair = F.explode(F.array(F.struct("u", "low"), F.struct(F.col("v").alias("u"), "low")))
    return linked.select(pair.alias("e")).select(
        F.col("e.u").alias("u"), F.col("e.low").alias("v")
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (columns ``u``, ``v`` of one type).

    The root is the lowest node of the component. Large-star and small-star steps take
    turns until nothing changes; each round is written to the shared folder, so the
    lineage stays short and a lost executor costs one round at most.
    """
    proper = edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct()
    now, before = staged(proper, "edges"), None
    for _ in range(rounds):
        digest = now.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
        ).first()
        if digest == before:
            break
        before = digest
        stars = _small_star(_large_star(now)).filter(F.col("u") != F.col("v")).distinct()
        now = staged(stars, "edges")
    else:
        raise RuntimeError(f"no components after {rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
