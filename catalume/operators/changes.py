"""Changes between two runs: report diffs, signals, comparison with baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalume.functions.text import signed

SKIPPED = ("non_inventariabile", "protocol_not_supported")


def _pair(cur: DataFrame, prev: DataFrame, how: str) -> DataFrame:
    side = lambda df, p: df.select("source_id", *[F.col(c).alias(f"{p}_{c}") for c in ("protocol", "status", "method", "row_count", "error")], F.lit(True).alias(f"in_{p}"))
    return side(cur, "c").join(side(prev, "p"), "source_id", how)


def report_diff(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """source_id, change, delta (signed text), message_changed; sources without a change are left out."""
    df = _pair(cur, prev, "full")
    ok = lambda p: F.coalesce(F.col(f"{p}_status"), F.lit("ok")) == "ok"
    rows = F.coalesce("c_row_count", F.lit(0)) - F.coalesce("p_row_count", F.lit(0))
    change = F.when(F.col("in_p").isNull(), "added").when(F.col("in_c").isNull(), "removed").when(ok("p") & ~ok("c"), "regression").when(~ok("p") & ok("c"), "recovery").when(~ok("p") & ~ok("c"), "persistent_error").when(rows != 0, "row_change")
    other = ~F.col("p_error").eqNullSafe(F.col("c_error"))
    return df.select("source_id", change.alias("change"), F.when(change == "row_change", signed(rows)).alias("delta"), F.when(change == "persistent_error", other).alias("message_changed")).where("change is not null")


def signals(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """source, signal_type, result, metric_value for every source of cur, by the first rule that holds."""
    df = _pair(cur, prev, "left")
    c, p = F.col("c_status"), F.col("p_status")
    both = (c == "ok") & (p == "ok")
    method_differs = both & F.col("p_method").isNotNull() & ~F.col("p_method").eqNullSafe(F.col("c_method"))
    rows_differ = both & (F.col("c_row_count") != F.col("p_row_count"))
    rules = (
        (c.isin(*SKIPPED) & (p == "ok"), "structural drift", "regressione", False),
        (c.isin(*SKIPPED), "no signal", "stabile", False),
        (c == "error", "health", "regressione", False),
        ((c == "ok") & (p == "error"), "health", "recovery", True),
        (method_differs, "missing_data", "missing_data", True),
        (rows_differ, "inventory change", "inventory change", True),
        (c == "ok", "no signal", "stabile", True),
    )

    def pick(k: int, last):
        out = None
        for rule in rules:
            value = F.col("c_row_count") if k == 3 and rule[3] else F.lit(None).cast("long") if k == 3 else F.lit(rule[k])
            hit = F.coalesce(rule[0], F.lit(False))
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out.otherwise(last)

    same = (c == "error") & (p == "error")
    return df.select(F.col("source_id").alias("source"), F.col("c_protocol").alias("protocol"), pick(1, F.lit("no signal")).alias("signal_type"), pick(2, F.lit("stabile")).alias("result"), pick(3, F.lit(None).cast("long")).alias("metric_value"), F.when(same, ~F.col("p_error").eqNullSafe(F.col("c_error"))).alias("error_changed"))


# What a signal says, and what to do about it. %s stand for what the report has.
DETAILS = {
    "dropped": ("Fonte non più inventariabile.", "verificare causa — fonte precedentemente ok"),
    "skipped": ("Fonte non inventariabile.", "nessuna"),
    "error_again": ("Errore persistente: %s", "valutare declassamento a radar-only se persiste"),
    "error": ("Errore: %s", "monitorare nei prossimi run"),
    "recovery": ("Tornato ok. %s item (%s).", "nessuna"),
    "method": ("Metodo cambiato: precedente '%s', attuale '%s'. Delta non confrontabile con la baseline.", "verificare causa cambio metodo; non usare delta come segnale"),
    "rows": ("%s item (%s), delta %s rispetto al run precedente (%s).", "verificare se variazione attesa; avviare catalog-inventory-scout se nuovi dataset"),
    "stable": ("%s item (%s), in linea con la baseline.", "nessuna"),
    "other": ("Status non gestito: %s", "nessuna"),
}
CHANGED, NO_ERROR, NO_METHOD = " (messaggio cambiato rispetto al run precedente)", "errore sconosciuto", "n/d"


def signal_details(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """signals with detail and suggested_action. A column reason of cur tells why a source is skipped."""
    reason = F.col("reason") if "reason" in cur.columns else F.lit(None).cast("string")
    df = _pair(cur, prev, "left").join(cur.select("source_id", reason.alias("reason")), "source_id")
    c, p = F.col("c_status"), F.col("p_status")
    rows, before = F.coalesce("c_row_count", F.lit(0)), F.coalesce("p_row_count", F.lit(0))
    method, error = F.coalesce("c_method", F.lit(NO_METHOD)), F.coalesce("c_error", F.lit(NO_ERROR))
    both = (c == "ok") & (p == "ok")
    kind = F.when(c.isin(*SKIPPED), F.when(p == "ok", "dropped").otherwise("skipped")).when(c == "error", F.when(p == "error", "error_again").otherwise("error")).when(c == "ok", F.when(p == "error", "recovery").when(both & F.col("p_method").isNotNull() & (F.col("p_method") != method), "method").when(both & (rows != before), "rows").otherwise("stable")).otherwise("other")
    text = {"error_again": (error,), "error": (error,), "recovery": (rows, method), "method": (F.col("p_method"), method), "rows": (rows, method, signed(rows - before), before), "stable": (rows, method), "other": (c,)}
    detail, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (form, todo) in DETAILS.items():
        said = F.format_string(form, *text[name]) if name in text else F.coalesce("reason", F.lit(form))
        if name == "error_again":
            said = F.concat(said, F.when(~error.eqNullSafe(F.coalesce("p_error", F.lit(""))), CHANGED).otherwise(""))
        detail, action = F.when(F.col("kind") == name, said).otherwise(detail), F.when(F.col("kind") == name, todo).otherwise(action)
    said = df.withColumn("kind", kind).select(F.col("source_id").alias("source"), detail.alias("detail"), action.alias("suggested_action"))
    return signals(cur, prev).drop("error_changed").join(said, "source")


def sources_checked(report: DataFrame, captured_at: Column) -> DataFrame:
    """captured_at, and how many sources a report has."""
    return report.agg(F.count("*").alias("sources_checked")).select(captured_at.alias("captured_at"), "sources_checked")


def ordered(diff: DataFrame) -> DataFrame:
    """A diff in the order in which it is shown, by source_id."""
    return diff.orderBy("source_id")


def full_report(routed: DataFrame, items: DataFrame, outcomes: DataFrame) -> DataFrame:
    """source_id, protocol, status, method, row_count, error, reason, warning of each routed source (with baseline_method and reason). outcomes: source_id, error and warning of those that were harvested.

    A source with an error has no rows; one that is skipped has its reason. method is the configured one; if items have an inventory_method, observed_method is the one that most rows of the source have.
    """
    method = F.col("baseline_method") if "baseline_method" in routed.columns else F.lit(None).cast("string")
    known = routed.select("source_id", method.alias("method"), "reason").join(outcomes.select("source_id", "error", "warning"), "source_id", "left")
    df = source_report(routed, items).join(known, "source_id")
    failed = (F.col("status") == "ok") & F.col("error").isNotNull()
    ok = (F.col("status") == "ok") & ~failed
    return df.select("source_id", "protocol", F.when(failed, "error").otherwise(F.col("status")).alias("status"), "method", F.when(ok, F.col("row_count")).alias("row_count"), F.when(failed, F.col("error")).alias("error"), "reason", F.when(ok, F.col("warning")).alias("warning")).transform(lambda x: _observed(x, items))


def _observed(report: DataFrame, items: DataFrame) -> DataFrame:
    if "inventory_method" not in items.columns:
        return report
    counts = items.groupBy("source_id", "inventory_method").agg(F.count("*").alias("n"))
    return report.join(counts.groupBy("source_id").agg(F.max_by("inventory_method", F.struct("n", "inventory_method")).alias("observed_method")), "source_id", "left")


def signal_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("signal_type", "result").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("source")), ",").alias("sources"))


def carry_report(prev: DataFrame, cur: DataFrame) -> DataFrame:
    return cur.unionByName(prev.join(cur.select("source_id"), "source_id", "left_anti"))


def baseline_compare(report: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of each source against the registry's baseline, where both were counted by the same method: the one observed in the rows, if the report knows it (observed_method), or else the configured one."""
    if "observed_method" in report.columns:
        report = report.withColumn("method", F.coalesce("observed_method", "method"))
    df = report.join(registry.select("source_id", "baseline_method", "baseline_value"), "source_id", "left")
    same = F.col("method").eqNullSafe(F.col("baseline_method"))
    base = F.col("baseline_value").try_cast("bigint")
    result = F.when(~same | base.isNull(), "missing_data").when(F.col("row_count") == base, "stable").otherwise("changed")
    return df.select("source_id", result.alias("result"), F.when(same, F.col("row_count") - base).alias("delta"))


def source_report(routed: DataFrame, items: DataFrame) -> DataFrame:
    """Per routed source: status, and how many items it has."""
    counts = items.groupBy("source_id").agg(F.count("*").alias("row_count"))
    status = F.when(F.col("status") == "inventoriable", "ok").otherwise(F.col("status"))
    return routed.join(counts, "source_id", "left").select("source_id", "protocol", status.alias("status"), F.when(status == "ok", F.coalesce("row_count", F.lit(0))).alias("row_count"))
