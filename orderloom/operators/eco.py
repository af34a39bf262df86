"""Energy and emission reports over run logs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators import dedup, project

# Older header names of the run log, and grid factors (kg CO2e per kWh).
COLUMN_ALIASES = {
    "run-id": "run_id",
    "duration(s)": "duration",
    "emissions(kg)": "emissions",
    "energy_consumed(kWh)": "energy_consumed",
}
CARBON_FACTORS = {"low": 0.233, "world": 0.475}

REQUIRED = ("project_name", "emissions")
FALLBACK_KEY = ("project_name", "timestamp", "duration", "emissions")
# Amounts are added up as decimals, so totals do not depend on row order.
_EXACT = "decimal(38,20)"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Old header names to current ones, where present."""
    return project.rename_present(df, COLUMN_ALIASES)


def dedupe_runs(df: DataFrame, sequence: Iterable[str] = ("__source_file", "__line")) -> DataFrame:
    """Keep the last line of each run; without run ids, of each identical measurement."""
    sequence = [c for c in sequence if c in df.columns]
    if "run_id" in df.columns:
        keys = ["run_id"]
    else:
        keys = [c for c in FALLBACK_KEY if c in df.columns]
    return dedup.last_by_sequence(df, keys, sequence or keys)


def _total(c: str) -> Column:
    return F.sum(F.col(c).cast("double").cast(_EXACT)).cast("double")


def summary(runs: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Sums per phase with grams and minutes; absent optional columns are left out.

    ``exclude`` leaves out phases that overlap others in time.
    """
    project.require_columns(runs, REQUIRED, "run log")
    kept = runs.where(~F.col("project_name").isin(list(exclude))) if exclude else runs
    measures = ["emissions", *[c for c in ("energy_consumed", "duration") if c in runs.columns]]
    out = kept.groupBy("project_name").agg(*[_total(c).alias(c) for c in measures])
    out = out.withColumn("emissions_g", F.col("emissions") * 1000.0)
    if "duration" in measures:
        out = out.withColumn("duration_min", F.col("duration") / 60.0)
    return out.orderBy(F.col("emissions").desc(), "project_name")


def totals(per_phase: DataFrame) -> DataFrame:
    """Grand totals of a summary, as one row."""
    measures = [c for c in ("emissions", "emissions_g", "energy_consumed", "duration") if c in per_phase.columns]
    return per_phase.agg(*[_total(c).alias(f"total_{c}") for c in measures])


def shares(per_phase: DataFrame, measure: str = "emissions") -> DataFrame:
    """Each phase's percentage of the grand total (a scalar subquery, not a window)."""
    total = per_phase.agg(_total(measure).alias("t")).scalar()
    return per_phase.withColumn("share_pct", F.try_divide(F.col(measure) * 100.0, total))


def costs(
    per_phase: DataFrame,
    kwh_price: float,
    vm_hour_price: float = 0.0,
    carbon_tonne_price: float = 0.0,
    carbon_factor: float = CARBON_FACTORS["world"],
) -> DataFrame:
    """Mean power (kW), carbon intensity (kg/kWh), and energy, machine and carbon cost.

    ``factor_emissions`` is the emission implied by the energy and a grid factor.
    """
    hours = F.col("duration") / 3600.0
    return per_phase.select(
        "*",
        F.try_divide("energy_consumed", hours).alias("mean_power_kw"),
        F.try_divide("emissions", "energy_consumed").alias("carbon_intensity"),
        (F.col("energy_consumed") * F.lit(float(kwh_price))).alias("energy_cost"),
        (hours * F.lit(float(vm_hour_price))).alias("vm_cost"),
        (F.col("emissions") / 1000.0 * F.lit(float(carbon_tonne_price))).alias("carbon_cost"),
        (F.col("energy_consumed") * F.lit(float(carbon_factor))).alias("factor_emissions"),
    )


def markdown(per_phase: DataFrame, files: Iterable[str] = ()) -> str:
    """The summary (a row per phase) and its totals as a Markdown page."""
    rows, columns = per_phase.collect(), per_phase.columns
    grand = totals(per_phase).first().asDict()

    def cell(value) -> str:
        return f"{value:.6g}" if isinstance(value, float) else str(value)

    lines = ["# Emission report", ""]
    if files:
        lines += ["Files read:", "", *[f"- `{f}`" for f in files], ""]
    lines += ["## Phases", "", "| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    lines += ["| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in rows]
    lines += ["", "## Totals", ""]
    lines += [f"- emissions: {grand['total_emissions']:.6f} kg CO2e ({grand['total_emissions_g']:.2f} g)"]
    if grand.get("total_energy_consumed") is not None:
        lines.append(f"- energy: {grand['total_energy_consumed']:.6f} kWh")
    if grand.get("total_duration") is not None:
        seconds = grand["total_duration"]
        lines.append(f"- duration: {seconds:.1f} s ({seconds / 60.0:.1f} min)")
    return "\n".join(lines) + "\n"
