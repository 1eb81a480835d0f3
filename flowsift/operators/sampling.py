"""Splits, folds, samples and label-driven table transformations."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.draws import draw_key, index_draw, unit_draw
from flowsift.operators.joins import attach
from flowsift.operators.ranking import key_cuts, ranked, solid_strata
from flowsift.schema import BENIGN, quoted

# Pools below this many rows concentrate the join on too few keys.
SPREAD_KEYS = 10_000


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=allow_missing)
    return out


def stratified_split(
    df: DataFrame,
    strata: Sequence[str] | None,
    keys: Sequence[str],
    test: float,
    val: float,
    seed: int,
) -> DataFrame:
    """Append ``split`` (train, val, test); ``val`` is a share of all rows.

    With strata the shares are exact per stratum: ordered by a keyed hash, the first rows go to
    test, the next to val. The assignment compares each row's hash with two cut keys per stratum,
    so the wide rows are never shuffled. Without strata the hash is compared with the shares.
    """
    if strata is None:
        u = unit_draw(keys, seed)
        name = F.when(u < test, "test").when(u < test + val, "val").otherwise("train")
        return df.withColumn("split", name)
    keyed, strata = solid_strata(df.withColumn("__key", draw_key(keys, seed)), strata)
    n_test = lambda n: F.floor(n * test + 0.5)
    n_val = lambda n: F.floor(n * val + 0.5)
    cuts = key_cuts(
        keyed, strata, "__key", {"__test": n_test, "__val": lambda n: n_test(n) + n_val(n)}
    ).drop("n")
    name = (
        F.when(F.col("__key") <= F.col("__test"), "test")
        .when(F.col("__key") <= F.col("__val"), "val")
        .otherwise("train")
    )
    return attach(keyed, cuts, strata).withColumn("split", name).drop("__key", "__test", "__val", *strata)


def split_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def kfold(df: DataFrame, label: str, keys: Sequence[str], k: int, seed: int) -> DataFrame:
    """Append ``fold`` in [0, k): shuffled folds whose class counts differ by at most one."""
    keyed = df.withColumn("__key", draw_key(keys, seed))
    return (
        ranked(keyed, [label], "__key", "__rank")
        .withColumn("fold", F.pmod(F.col("__rank") - 1, F.lit(k)).cast("int"))
        .drop("__key", "__rank")
    )


def draw_rows(df: DataFrame, keys: Sequence[str], draws: int, seed: int) -> DataFrame:
    """Exactly ``draws`` rows drawn with replacement; a row drawn twice appears twice.

    Rows are numbered by keyed hash, draws are generated in parallel, counted per number and joined
    on it, so both sides are spread evenly.
    """
    spark = df.sparkSession
    total = df.count()
    numbered = ranked(df.withColumn("__key", draw_key(keys, seed)), [], "__key", "__number").drop("__key")
    picks = (
        spark.range(draws)
        .select((index_draw(["id"], F.lit(total), seed, "pick") + 1).alias("__number"))
        .groupBy("__number")
        .agg(F.count(F.lit(1)).alias("__times"))
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))
    return numbered.join(picks, "__number").withColumn("__copy", copies).drop("__number", "__times", "__copy")


def mix_quotas(mix: Mapping[str, float], n: int) -> dict[str, int]:
    """Rows per label for ``n`` rows: floors of the shares, the remainder to the largest share."""
    whole = sum(mix.values())
    quotas = {label: math.floor(share / whole * n) for label, share in mix.items()}
    largest = max(mix, key=lambda label: mix[label])
    quotas[largest] += n - sum(quotas.values())
    return quotas


def resample_to_mix(
    df: DataFrame, label: str, mix: Mapping[str, float], n: int, keys: Sequence[str], seed: int
) -> DataFrame:
    """Rows chosen so that the labels meet a target mix; a label with too few rows keeps them all."""
    quotas = mix_quotas(mix, n)
    pairs = [F.lit(v) for item in quotas.items() for v in item]
    allowed = df.where(F.col(quoted(label)).isin(*quotas)).withColumn("__key", draw_key(keys, seed))
    slim = allowed.select(label, "__key").withColumn(
        "__quota", F.element_at(F.create_map(*pairs), F.col(label)).cast("bigint")
    )
    cuts = key_cuts(
        slim, [label, "__quota"], "__key", {"__cut": lambda n_rows: F.least(n_rows, F.col("__quota"))}
    ).select(label, "__cut")
    return attach(allowed, cuts, [label]).where(F.col("__key") <= F.col("__cut")).drop("__key", "__cut")


def corrupt_cells(
    df: DataFrame, cols: Sequence[str], fraction: float, keys: Sequence[str], seed: int
) -> DataFrame:
    """Set a share of each column's cells to infinity and NaN, half each.

    The cells are the first floor(n * fraction) rows by a keyed hash per column; all columns share
    one counting pass.
    """
    drawn = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("name"), draw_key(keys, seed, c).alias("__key")) for c in cols]
            )
        ).alias("d")
    ).select("d.name", "d.__key")
    bad = lambda n: F.floor(n * fraction)
    cuts = key_cuts(
        drawn, ["name"], "__key", {"inf": lambda n: F.floor(bad(n) / 2), "bad": bad}
    )
    limits = {r["name"]: (r["inf"], r["bad"]) for r in cuts.limit(len(cols)).collect()}

    def corrupted(c: str) -> Column:
        first, last = limits.get(c, (None, None))
        value, key = F.col(quoted(c)), draw_key(keys, seed, c)
        if last is None:
            return value
        out = F.when(key <= F.lit(last), F.lit(float("nan")))
        if first is not None:
            out = F.when(key <= F.lit(first), F.lit(float("inf"))).when(key <= F.lit(last), F.lit(float("nan")))
        return out.otherwise(value).alias(c)

    return df.select(*[corrupted(c) if c in cols else F.col(quoted(c)) for c in df.columns])


def scale_by_class(
    df: DataFrame, label: str, profile: DataFrame, drift: float = 1.0, benign: str = BENIGN
) -> DataFrame:
    """Multiply columns by a per-class factor, and by ``drift`` on non-benign classes.

    ``profile`` has one row per (class, feature) with its factor; classes or features it does not
    list keep their values.
    """
    known = profile.where(F.col("feature").isin(*df.columns)).select("feature").distinct()
    features = {r["feature"] for r in known.limit(len(df.columns)).collect()}
    factors = {c: f"__factor_{i}" for i, c in enumerate(c for c in df.columns if c in features)}
    wide = (
        profile.groupBy(F.col("class").alias(label))
        .agg(*[F.max(F.when(F.col("feature") == c, F.col("factor"))).alias(f) for c, f in factors.items()])
    )
    joined = attach(df, wide, [label], how="left")
    shift = F.when(F.col(quoted(label)) == benign, F.lit(1.0)).otherwise(F.lit(float(drift)))

    def scaled(c: str) -> Column:
        factor = F.col(factors[c])
        return F.when(factor.isNull(), F.col(quoted(c))).otherwise(F.col(quoted(c)) * (factor * shift)).alias(c)

    return joined.select(*[scaled(c) if c in factors else F.col(quoted(c)) for c in df.columns])


def pair_payloads(
    flows: DataFrame,
    flow_keys: Sequence[str],
    attack: str,
    texts: DataFrame,
    text_keys: Sequence[str],
    text_label: str,
    p_attack: float,
    p_benign: float,
    seed: int,
) -> DataFrame:
    """Give each flow a payload row: malicious with probability ``p_attack`` or ``p_benign``.

    The pools are the texts labelled 1 and 0; other labels are in neither. Their rows are numbered
    densely and a flow draws (pool, number, copy), which spreads the join evenly: a pool of few rows is
    copied so often that there are ``SPREAD_KEYS`` keys. Payloads have no length bound, so they are
    never broadcast. A pool that flows may draw from must have rows.
    """
    pool = F.col(text_label).cast("int")
    usable = texts.where(pool.isin(0, 1))
    sizes = usable.agg(F.count_if(pool == 0), F.count_if(pool == 1)).head()
    drawable = (min(p_attack, p_benign) < 1, max(p_attack, p_benign) > 0)
    empty = [i for i in (0, 1) if drawable[i] and not sizes[i]]
    if empty:
        raise ValueError(f"no payload is labelled {empty[0]}")
    copies = [-(-SPREAD_KEYS // n) if n else 1 for n in sizes]

    def by_pool(column: Column, values: Sequence[int]) -> Column:
        return F.when(column == 1, F.lit(values[1])).otherwise(F.lit(values[0]))

    numbered = ranked(
        usable.withColumn("__pool", pool).withColumn("__tkey", draw_key(text_keys, seed, "pool")),
        ["__pool"],
        "__tkey",
        "__number",
    ).drop("__tkey")
    numbered = numbered.withColumn("__copy", F.explode(F.sequence(F.lit(0), by_pool(F.col("__pool"), copies) - 1)))
    p = F.when(F.col(attack) == 1, F.lit(p_attack)).otherwise(F.lit(p_benign))
    drawn = flows.withColumn("__pool", (unit_draw(flow_keys, seed, "pool") < p).cast("int"))
    drawn = drawn.withColumn("__number", index_draw(flow_keys, by_pool(F.col("__pool"), sizes), seed, "number") + 1)
    drawn = drawn.withColumn("__copy", index_draw(flow_keys, by_pool(F.col("__pool"), copies), seed, "copy").cast("int"))
    on = ["__pool", "__number", "__copy"]
    return drawn.join(numbered, on, "left").drop(*on)
