"""Host-level quality rules: rule failures per host, shrunk by an empirical beta prior, joined back.

Only DataFrame functions: the words, the window hashes and the aggregates
all stay in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policylens.llm.text import SPACES, Scratch, small, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class HostRules:
    """min_words, max_repeat_pct: the base rules. max_symbol_pct (symbols per 100 word characters)
    and max_dup_line_pct (repeated lines per 100 lines with a word) are counted for hosts only.
    A host is rejected whose shrunk failure rate exceeds the prior's mean by ``deviations`` of its standard deviations (the
    upper tail of what hosts are like) and ``least_limit``; above ``host_limit`` it is rejected whatever the others are like."""

    min_words: int = 20
    max_repeat_pct: int = 30
    max_symbol_pct: int = 10
    max_dup_line_pct: int = 30
    deviations: float = 2.0
    least_limit: float = 0.25
    host_limit: float = 0.5


def signals(docs: DataFrame, text: Column, **carry: Column) -> DataFrame:
    """The carried columns plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    n_repeat_words counts words inside 8-word windows that occur twice or
    more in the text. Windows are compared by a 64-bit hash; only a text in
    which some window recurs pays for sorting its windows.
    """
    base = docs.select(*[c.alias(k) for k, c in carry.items()], F.coalesce(text, F.lit("")).alias("_t"))
    base = base.withColumn("_w", words(F.col("_t")))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    base = base.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.translate("_t", SPACES, "")).cast("long"),
        "n_symbols": (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long"),
        "_l": lines,
        "_h": F.transform("_w", lambda x: F.xxhash64(x)),
    }).withColumns({
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_g": F.when(F.size("_h") < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.slice("_h", F.lit(1), F.size("_h") - (WINDOW - 1)),
                        lambda x, i: F.xxhash64(x, *[F.get(F.col("_h"), i + k) for k in range(1, WINDOW)]))),
    })
    base = base.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.sort_array(
        F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.transform("_s", lambda x, k: F.when(
        (x["h"] == F.get(F.col("_s"), k - 1)["h"]) | (x["h"] == F.get(F.col("_s"), k + 1)["h"]), x["i"]))
    base = base.withColumn("_p", F.sort_array(F.filter(again, lambda x: x.isNotNull())))
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_p"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return base.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_t", "_w", "_l", "_h", "_g", "_s", "_p")


def base_failed(rules: HostRules) -> Column:
    return (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))


def any_failed(rules: HostRules) -> Column:
    """What counts against a host: the base rules, many symbols, or many repeated lines."""
    return (base_failed(rules) | (100 * F.col("n_symbols") > rules.max_symbol_pct * F.col("word_chars"))
            | (100 * F.col("n_dup_lines") > rules.max_dup_line_pct * F.col("n_lines")))


def host_verdicts(rows: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """(host, n, f, rate, limit, rejected) from rows of (host, failed).

    The beta prior is fitted by moments over the hosts: mean m, and the
    variance of host rates beyond binomial noise gives the strength. One host
    holding most rows is combined before the shuffle. A null host is a host. Where hosts do not differ beyond noise the prior
    is narrow and every rate shrinks to its mean, so none is rejected for being unlucky.
    """
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("f"))
    total = hosts.agg(F.sum("n").cast("double").alias("n"), F.sum("f").cast("double").alias("f"), F.count(F.lit(1)).cast("double").alias("h"),
                      F.sum(F.col("f").cast("double") * F.col("f") / F.col("n")).alias("q"))
    m = F.col("f") / F.col("n")
    total = total.select("*", m.alias("m"), (m * (1 - m)).alias("mv"))
    total = total.select("m", "mv", (F.col("q") / F.col("n") - F.col("m") * F.col("m") - F.col("mv") * F.col("h") / F.col("n")).alias("between"))
    strength = F.when(F.col("mv") <= 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(1.0), F.col("mv") / F.greatest(F.col("between"), F.lit(1e-9)) - 1))
    prior = total.select(F.struct("m", strength.alias("s")).alias("prior"))
    rate = (F.col("f") + F.col("p.m") * F.col("p.s")) / (F.col("n") + F.col("p.s"))
    tail = F.col("p.m") + rules.deviations * F.sqrt(F.col("p.m") * (1 - F.col("p.m")) / (F.col("p.s") + 1))
    limit = F.least(F.lit(rules.host_limit), F.greatest(F.lit(rules.least_limit), tail))
    return (hosts.withColumn("p", prior.scalar()).select("host", "n", "f", rate.alias("rate"), limit.alias("limit"))
            .withColumn("rejected", F.col("rate") > F.col("limit")))


def judged(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """doc_id, host, the signals, base_failed, host_rate and kept of every row of ``docs`` (doc_id, text, source).

    kept is false for a document that fails a base rule or whose host is
    rejected. A null text has no words (too short); a null source is a host
    of its own; repeated rows count once each; an empty table gives no rows. Texts are read
    whole, whatever their length; columns other than these three are not read, so names cannot clash.
    The narrow signals are written once, so the texts are read once.
    """
    spark = docs.sparkSession
    own = signals(docs, docs["text"], doc_id=docs["doc_id"], host=docs["source"])
    own = Scratch(spark, "host-rules").keep(own.withColumns({"base_failed": base_failed(rules), "failed": any_failed(rules)}))
    hosts, rows = _written(host_verdicts(own, rules))
    out = own.join(small(hosts, rows).withColumnRenamed("host", "h"), own["host"].eqNullSafe(F.col("h")), "left")
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))).withColumnRenamed("rate", "host_rate").drop("h", "n", "f", "limit", "rejected", "failed")


def reject(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """The rows of ``docs``, all columns, that pass their base rules and whose host is not rejected.

    The texts are read twice (once for the hosts' rates, once to decide) and never shuffled unless the hosts outgrow a broadcast.
    """
    spark = docs.sparkSession
    own = signals(docs, docs["text"], host=docs["source"]).select("host", any_failed(rules).alias("failed"))
    hosts, rows = _written(host_verdicts(own, rules))
    hosts = hosts.select(F.col("host").alias("_host"), "rejected")
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    # the id keeps the filter above the signals; pushed below, it would repeat their expressions many times over
    out = signals(docs, docs["text"], row=row, host=docs["source"]).withColumn("_at", F.monotonically_increasing_id())
    out = out.where(~base_failed(rules) & (F.col("_at") >= 0))
    bad = hosts.where("rejected")
    return out.join(small(bad, rows), out["host"].eqNullSafe(bad["_host"]), "left_anti").select("row.*")


def _written(hosts: DataFrame) -> tuple[DataFrame, int]:
    hosts = Scratch(hosts.sparkSession, "hosts").keep(hosts)
    return hosts, hosts.count()
