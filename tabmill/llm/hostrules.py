"""Quality rules on texts, and verdicts on whole hosts.

Each text is counted with array expressions inside its row; no word leaves its row, so nothing is shuffled but one
row per host. Rule failures are added up by host (pre-aggregated before the shuffle), the failure rates are shrunk towards all hosts
by a beta prior fitted to the rates, and hosts beyond the limit are rejected with all their documents.

Words are runs of characters other than space and the five ASCII controls 9-13. Defined results: a null text has no words and fails the
base rule; a document without host is judged by the base rule alone; repeated rows count as often as they occur;
an empty table gives no rows. Only the named columns of the input are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.session import materialize

SPACES = "[ \\t-\\r]+"
SYMBOLS = "#*$%&|<>"
#: A host is rejected if its shrunk failure rate of any rule lies above this.
HOST_LIMIT = 0.5
#: Bounds of the prior's weight in documents: hosts that are all alike would give an infinite one.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 10_000.0
RULES = ("base", "symbols", "lines", "word_length")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _words_in_repeated(windows: Column) -> Column:
    """Words covered by windows whose hash occurs again; sorted by hash, equal windows stand side by side."""

    def covered(ordered):
        def again(j):
            here, left, right = (F.get(ordered, j + d)["hash"] for d in (0, -1, 1))
            return F.coalesce(here == left, F.lit(False)) | F.coalesce(here == right, F.lit(False))

        kept = F.filter(ordered, lambda w, j: again(j))
        return F.size(F.array_distinct(F.flatten(F.transform(kept, lambda w: F.sequence(w["at"], w["at"] + 2)))))

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(ordered, covered))


def count_rules(
    docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """Per row: id, host, the counters of the text, and which rules it fails; with ``carry`` the whole row as ``row``."""
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    windows = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    first = [F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.coalesce(text_col, F.lit("")).alias("text")]
    kept = ["doc_id", "host"]
    if carry:
        first.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        kept.append("row")
    counted = (
        docs.select(*first)
        .select(
            *kept, words.alias("words"), lines.alias("lines"),
            F.length(F.translate("text", " \t\n\x0b\f\r", "")).alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        )
        .select(
            *kept, "word_chars", "n_symbols", F.size("words").alias("n_words"), F.size("lines").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
            windows.alias("windows"),
        )
        .withColumn("n_repeat_words", _words_in_repeated(F.col("windows")))
        .drop("windows")
    )
    numbers = ["word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines", "n_repeat_words"]
    return counted.withColumns({c: F.col(c).cast("long") for c in numbers}).withColumns({
        "fails_base": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "fails_symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "fails_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "fails_word_length": (F.col("word_chars") > 10 * F.col("n_words")) | (F.col("word_chars") < 3 * F.col("n_words")),
    })


def host_rates(counted: DataFrame) -> DataFrame:
    """Documents and failures per rule of every host."""
    return counted.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n_docs"), *[F.sum(F.col(f"fails_{r}").cast("long")).alias(f"n_{r}") for r in RULES]
    )


def beta_prior(rates: DataFrame) -> DataFrame:
    """One row: mean and weight of the beta distribution with the mean and variance of the hosts' rates, per rule."""
    rate = {r: F.col(f"n_{r}") / F.col("n_docs") for r in RULES}
    moments = rates.agg(
        *[F.avg(rate[r]).alias(f"mean_{r}") for r in RULES], *[F.var_pop(rate[r]).alias(f"var_{r}") for r in RULES]
    )

    def weight(r):
        m, v = F.col(f"mean_{r}"), F.col(f"var_{r}")
        fitted = F.when(v > 0, m * (1 - m) / v - 1).otherwise(F.lit(MOST_WEIGHT))
        return F.least(F.greatest(fitted, F.lit(LEAST_WEIGHT)), F.lit(MOST_WEIGHT))

    return moments.select(*[f"mean_{r}" for r in RULES], *[weight(r).alias(f"weight_{r}") for r in RULES])


def host_verdicts(rates: DataFrame) -> DataFrame:
    """Every host with its shrunk rates and whether it is rejected."""
    shrunk = {
        f"rate_{r}": (F.col(f"n_{r}") + F.col(f"mean_{r}") * F.col(f"weight_{r}")) / (F.col("n_docs") + F.col(f"weight_{r}"))
        for r in RULES
    }
    judged = rates.join(F.broadcast(beta_prior(rates))).withColumns(shrunk)  # the prior is one row
    rejected = F.greatest(*[F.col(c) for c in shrunk]) > HOST_LIMIT
    return judged.select("host", "n_docs", *shrunk, rejected.alias("host_rejected"))


def _passes() -> Column:
    return ~F.col("fails_base") & ~F.coalesce("host_rejected", F.lit(False))


def judge(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """Counters of every row, ``base_failed`` and ``kept``; texts are read once, and only counters are stored."""
    counted = materialize(count_rules(docs, id_col, host_col, text_col), "rule-counts")
    verdicts = materialize(host_verdicts(host_rates(counted)), "host-verdicts")
    return counted.join(verdicts.select("host", "host_rejected"), "host", "left").select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("fails_base").alias("base_failed"), _passes().alias("kept"),
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows that ``judge`` keeps, whole. Rows are stored with their flags, so texts are read once and not shuffled."""
    counted = count_rules(docs, id_col, host_col, text_col, carry=True)
    counted = materialize(counted.select("host", "row", *[f"fails_{r}" for r in RULES]), "rule-flags")
    verdicts = materialize(host_verdicts(host_rates(counted)), "host-verdicts")
    return counted.join(verdicts.select("host", "host_rejected"), "host", "left").where(_passes()).select("row.*")
