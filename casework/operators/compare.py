"""Comparing tables: mismatches, missing keys, orphans, reconciliation, differences, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def channel_mismatch(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Keys present in one system only, or whose fields differ: ``problem`` and both values."""
    left = a.select(F.col(key).alias("__a"), *[F.col(c).alias(f"{c}_a") for c in fields])
    right = b.select(F.col(key).alias("__b"), *[F.col(c).alias(f"{c}_b") for c in fields])
    differs = reduce(lambda x, y: x | y, [~F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in fields])
    problem = F.when(F.col("__b").isNull(), "missing_in_b").when(F.col("__a").isNull(), "missing_in_a").when(differs, "different")
    joined = left.join(right, F.col("__a") == F.col("__b"), "full_outer")
    return joined.select(F.coalesce("__a", "__b").alias(key), problem.alias("problem"), *[f"{c}_{s}" for c in fields for s in "ab"]).where("problem is not null")


def missing_required(groups: DataFrame, group: str, required: Sequence[str], present: DataFrame, key: str, mandatory: Sequence[str] = ()) -> DataFrame:
    """Status per group: FAIL when a mandatory key is absent, WARN when another is, else PASS.

    The required keys are a parameter. Present pairs are made distinct before the shuffle.
    """
    have = present.where(F.col(key).isin(*required)).groupBy(group).agg(F.collect_set(key).alias("__have"))
    needed = F.array(*[F.lit(r) for r in required])
    joined = groups.select(group).distinct().join(have, group, "left")
    absent = F.array_except(needed, F.coalesce("__have", F.array().cast("array<string>")))
    out = joined.select(group, F.sort_array(absent).alias("missing"))
    fails = F.arrays_overlap("missing", F.array(*[F.lit(m) for m in mandatory]).cast("array<string>"))
    return out.withColumn("status", F.when(F.size("missing") == 0, "PASS").when(fails, "FAIL").otherwise("WARN"))


def orphans(assets: DataFrame, staff: DataFrame, owner: str, staff_id: str) -> DataFrame:
    """Assets per owner who is no longer on the staff list."""
    gone = assets.groupBy(owner).agg(F.count(F.lit(1)).alias("assets"))
    return gone.join(staff.select(F.col(staff_id).alias(owner)), owner, "left_anti")


def reconcile(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row counts of both sides and rows (with multiplicity) missing from or extra in the target.

    One aggregation over the signed union instead of two multiset differences.
    """
    signed = source.select(*columns, F.lit(1).alias("__s")).unionByName(target.select(*columns, F.lit(-1).alias("__s")))
    per_row = signed.groupBy(*columns).agg(F.sum("__s").alias("d"), F.count_if(F.col("__s") > 0).alias("s"), F.count_if(F.col("__s") < 0).alias("t"))
    out = per_row.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"),
        F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("extra"),
    )
    return out.withColumn("matched", (F.col("missing") == 0) & (F.col("extra") == 0))


def override_default(fact: DataFrame, ref: DataFrame, key: str, value: str, default: str, out: str = "probability") -> DataFrame:
    """The fact's own value, or the default of its key."""
    return fact.join(ref.select(key, default), key, "left").withColumn(out, F.coalesce(value, default)).drop(default)


def scope_diff(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows with their place: ``only_a``, ``only_b`` or ``both``."""
    both = a.select(*columns, F.lit(1).alias("__f")).unionByName(b.select(*columns, F.lit(2).alias("__f")))
    seen = both.groupBy(*columns).agg(F.bit_or("__f").alias("__f"))
    place = F.when(F.col("__f") == 1, "only_a").when(F.col("__f") == 2, "only_b").otherwise("both")
    return seen.withColumn("place", place).drop("__f")


def union_runs(*runs: DataFrame) -> DataFrame:
    """Runs stacked by column name; columns a run lacks become null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), runs)


def sample_per_group(df: DataFrame, key: str, id: str, n: int, seed: int = 42) -> DataFrame:
    """Up to ``n`` rows per group in a repeatable random order (hash of seed and id)."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id).cast("string")))
    w = Window.partitionBy(key).orderBy(draw, F.col(id))
    return df.withColumn("pick", F.row_number().over(w).cast("long")).where(F.col("pick") <= n)


def connector_policy(
    flows: DataFrame, tiers: DataFrame, flow: str, connector: str, environment: str, exempt: Sequence[str] = ("Development", "Sandbox")
) -> DataFrame:
    """Per flow: number of tiers, a blocked connector, mixed tiers, and the decision.

    Unclassified connectors count as Non-Business. Exempt environments have no policy.
    """
    t = tiers.select(F.col("connector").alias(connector), "tier")
    tiered = flows.join(t, connector, "left").withColumn("tier", F.coalesce("tier", F.lit("Non-Business")))
    blocked = F.bool_or(F.col("tier") == "Blocked")
    # Two flags and an OR need no distinct aggregation.
    business, other = F.bool_or(F.col("tier") == "Business"), F.bool_or(F.col("tier") == "Non-Business")
    out = tiered.groupBy(flow, environment).agg(blocked.alias("has_blocked"), business.alias("__b"), other.alias("__n"))
    out = out.withColumn("mixed", F.col("__b") & F.col("__n")).drop("__b", "__n")
    decision = (
        F.when(F.col(environment).isin(*exempt), "exempt").when(F.col("has_blocked"), "blocked").when(F.col("mixed"), "suspended").otherwise("allowed")
    )
    return out.withColumn("decision", decision)


def multi_owner(df: DataFrame, item: str, owner: str) -> DataFrame:
    """Items claimed by more than one owner."""
    return df.groupBy(item).agg(F.countDistinct(owner).alias("owners")).where("owners > 1")


def quality_gate(df: DataFrame, group: str, checks: dict[str, tuple[Column, str]]) -> DataFrame:
    """Per group: PASS / WARN / FAIL totals over checks, the verdict and failing check names.

    ``checks`` maps a name to ``(row condition, level)`` with level ``mandatory`` or ``advisory``;
    a check passes for a group when every row satisfies it.
    """
    held = df.groupBy(group).agg(*[F.bool_and(F.coalesce(c, F.lit(False))).alias(f"__{n}") for n, (c, _) in checks.items()])
    count = lambda names: reduce(lambda x, y: x + y, [F.col(n).cast("long") for n in names], F.lit(0).cast("long"))
    broken = {level: [~F.col(f"__{n}") for n, (_, lv) in checks.items() if lv == level] for level in ("mandatory", "advisory")}
    total = lambda cs: reduce(lambda x, y: x + y, [c.cast("long") for c in cs], F.lit(0).cast("long"))
    out = held.select(
        group,
        count([f"__{n}" for n in checks]).alias("passed"),
        total(broken["advisory"]).alias("warned"),
        total(broken["mandatory"]).alias("failed"),
        F.array_compact(F.array(*[F.when(~F.col(f"__{n}"), F.lit(n)) for n in checks])).alias("reasons"),
    )
    return out.withColumn("verdict", F.when(F.col("failed") > 0, "FAIL").when(F.col("warned") > 0, "WARN").otherwise("PASS"))


def completeness(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Null-or-empty count per required column, and complete rows, from one pass."""
    empty = {c: F.col(c).isNull() | (F.col(c).cast("string") == "") for c in required}
    complete = reduce(lambda x, y: x & y, [~e for e in empty.values()])
    one = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(complete).alias("complete_rows"), *[F.count_if(e).alias(f"__{c}") for c, e in empty.items()])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{c}").alias("missing")) for c in required])
    return one.select("rows", "complete_rows", F.inline(lines))
