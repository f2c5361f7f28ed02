"""State carry between cycles, mesh time repair, weight audit."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators import state as st
from gridspark.operators import timeaxis, weights
from gridspark.plans.inventories import Result
from gridspark.sources.products import violation_table


def carry_cycle(cold: DataFrame, source: DataFrame, keys: list[str], aux: DataFrame | None = None,
                bounds: dict[str, float] | None = None, **options) -> Result:
    """Carry the cycled state, then raise scalars to their lower bounds."""
    carried, report = st.carry_state(cold, source, keys, aux, **options)
    floored, raised = st.floor_values(carried, bounds)
    return Result(floored, violation_table({"carry": report.filter("fatal")}), {"report": report, "raised": raised})


def repair_times(values: DataFrame, records: DataFrame, start, end, step_seconds: int, keys: list[str], method: str = "linear",
                 max_gap_seconds: float | None = None) -> Result:
    """Regular schedule from an irregular mesh product; nothing moves horizontally."""
    filled, brackets = timeaxis.fill_times(values, records, start, end, step_seconds, keys, method, max_gap_seconds)
    bad = brackets.filter(F.col("kind").isin("outside", "gap", "no_records"))
    return Result(filled, violation_table({"bracket": bad, "duplicate_time": timeaxis.duplicate_times(records)}),
                  {"brackets": brackets, "summary": timeaxis.bracket_summary(brackets)})


def audit_weights(links: DataFrame, n_dst: int, n_src: int, dst_area: DataFrame | None = None, mesh: DataFrame | None = None,
                  require_full_src: bool = False) -> dict[str, DataFrame]:
    """Validation and statistics of one weight table (link_no, row, col, s; 1-based)."""
    w = weights.zero_based(links)
    out = {
        "violations": weights.validate_weights(w, n_dst, n_src, True, require_full_src),
        "per_destination": weights.link_statistics(w, "dst_id", n_dst), "per_source": weights.link_statistics(w, "src_id", n_src),
        "weights": weights.weight_statistics(w), "percentiles": weights.weight_percentiles(w), "order": weights.order_resets(links),
    }
    if dst_area is not None:
        out["area"] = weights.area_conservation(w, dst_area)
    if mesh is not None:
        out["five_sided"] = weights.five_sided(w, mesh)
    return out
