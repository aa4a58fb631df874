"""Host-level quality rules: document rules, failure rates by host shrunk with an empirical beta
prior, and host verdicts joined back to the documents. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from featureflow.llm.common import SPACES, c, fresh, stored, text_of, words

SYMBOLS = "#*$%&|<>"
POS_BITS = 30  # word position in the low bits of a sort key, trigram hash above

# Document rules by name, over the signals below. The base rules reject a document itself; all of
# them count as failures of its host.
BASE_RULES = {"short": "n_words < 50", "repetitive": "100 * n_repeat_words > 50 * n_words"}
HOST_RULES = {**BASE_RULES, "symbols": "10 * n_symbols > 3 * n_words", "dup_lines": "4 * n_dup_lines > n_lines"}


def _repeat_words(df: DataFrame, w: str, out: str, tmp: list[str]) -> DataFrame:
    """Adds ``out``: words covered by 3-word windows that occur twice or more in the array ``w``.

    Windows are sorted by (33 hash bits, position) as longs; neighbours with equal hash bits are
    candidates, and only those are compared by their words."""
    key, cand, hit = tmp
    wc, low = c(w), (1 << POS_BITS) - 1
    gram = lambda p: F.concat_ws(" ", F.get(wc, p), F.get(wc, p + 1), F.get(wc, p + 2))
    packed = lambda p: F.xxhash64(F.get(wc, p), F.get(wc, p + 1), F.get(wc, p + 2)).bitwiseAND(
        F.lit(~low)).bitwiseOR(p.cast("long"))
    df = df.withColumn(key, F.when(F.size(wc) >= 4, F.array_sort(F.transform(F.sequence(F.lit(0), F.size(wc) - 3), packed))))
    same = lambda x, y: F.coalesce(F.shiftright(x, POS_BITS) == F.shiftright(y, POS_BITS), F.lit(False))
    at = lambda a, i: F.when(i >= 0, F.get(a, i))
    near = F.filter(c(key), lambda x, i: same(x, at(c(key), i - 1)) | same(x, F.get(c(key), i + 1)))
    df = df.withColumn(cand, F.array_sort(F.transform(near, lambda x: F.struct(
        gram(x.bitwiseAND(F.lit(low)).cast("int")).alias("g"), x.bitwiseAND(F.lit(low)).cast("int").alias("p")))))
    equal = lambda x, y: F.coalesce(x["g"] == y["g"], F.lit(False))
    df = df.withColumn(hit, F.array_sort(F.transform(
        F.filter(c(cand), lambda x, i: equal(x, at(c(cand), i - 1)) | equal(x, F.get(c(cand), i + 1))), lambda x: x["p"])))
    covered = F.aggregate(c(hit), F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
                          lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
                          lambda a: a["n"])
    return df.withColumn(out, F.coalesce(covered, F.lit(0).cast("long"))).drop(key, cand, hit)


def document_signals(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with a struct ``out``: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    w, ln, rep, *tmp = fresh(df, "w_", "ln_", "rep_", "key_", "cand_", "hit_")
    t = text_of(c(text_col))
    left = lambda chars: F.length(F.translate(t, chars, "")).cast("long")
    df = df.withColumn(w, words(t))
    df = _repeat_words(df, w, rep, tmp)
    df = df.withColumn(ln, F.when(F.instr(t, "\n") > 0, F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")))
    n_lines = F.coalesce(F.size(F.when(c(ln).isNotNull(), c(ln))), F.lit(-1))
    full = F.struct(
        F.size(c(w)).cast("long").alias("n_words"), left(SPACES).alias("word_chars"),
        (F.length(t).cast("long") - left(SYMBOLS)).alias("n_symbols"),
        F.when(n_lines >= 0, n_lines).otherwise((F.size(c(w)) > 0).cast("int")).cast("long").alias("n_lines"),
        F.when(n_lines >= 0, n_lines - F.size(F.array_distinct(c(ln)))).otherwise(F.lit(0)).cast("long").alias("n_dup_lines"),
        c(rep).alias("n_repeat_words"))
    df = df.withColumn(out, full)
    return df.drop(w, ln, rep)


def _rule(signals: str, rule: str) -> Column:
    """A rule of the tables above, over the fields of the struct ``signals``."""
    fields = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    return F.expr(" ".join(f"`{signals}`.{x}" if x in fields else x for x in rule.split()))


def host_verdicts(marked: DataFrame, host: str, failed: str, max_rate: float) -> DataFrame:
    """One row per host (null is a host): n, failures, shrunk rate and verdict.

    The beta prior is fitted to the hosts by the method of moments: mean m of all rows' failures;
    variance of host rates beyond what binomial counts explain gives the prior's strength.
    Rate = (failures + alpha) / (n + alpha + beta), so a host of few documents stays near m."""
    hosts = marked.groupBy(c(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.sum(c(failed).cast("long")).alias("f"))
    hosts = stored(hosts, "quality-hosts")
    s = hosts.agg(F.sum("n").alias("n"), F.sum("f").alias("f"), F.count(F.lit(1)).alias("h"),
                  F.sum(F.col("f") * F.col("f") / F.col("n")).alias("sq")).first()
    total = s.n or 1
    m = (s.f or 0) / total
    spread = m * (1 - m)
    between = (s.sq or 0) / total - m * m - spread * (s.h or 0) / total
    strength = min(max(spread / between - 1, 1.0), 1e6) if between > 0 else 1e6
    alpha, beta = m * strength, (1 - m) * strength
    rate = (F.col("f") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    return hosts.select("host", F.col("n").alias("host_n"), F.col("f").alias("host_failed"), rate.alias("host_rate"),
                        (rate <= max_rate).alias("host_kept"))


def judge_documents(docs: DataFrame, host_col: str = "source", text_col: str = "text", out: str = "quality",
                    max_rate: float = 0.5, keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct ``out``: the signals, base_failed, the host's shrunk failure rate and kept.

    A document is kept if it fails no base rule and its host's shrunk rate of documents failing any
    rule is at most ``max_rate``. The signals are computed once and written to the shared folder
    (without the text if ``keep_text`` is false); hosts are a small join side that Spark broadcasts
    only where its size allows and joins with split hot hosts otherwise.
    Null and blank texts have no words and fail; null hosts are one host; repeated rows each count;
    an empty table gives an empty result; input columns keep their names (``out`` must be free).
    """
    if out.lower() in (n.lower() for n in docs.columns):
        raise ValueError(f"column {out} exists")
    q, failed, base = fresh(docs, "signals_", "host_failed_", "base_failed_")
    df = document_signals(docs, text_col, q)
    df = df.withColumn(base, _any(q, BASE_RULES)).withColumn(failed, _any(q, HOST_RULES))
    df = stored(df if keep_text else df.drop(text_col), "quality-signals")
    verdict = host_verdicts(df, host_col, failed, max_rate)
    hn = fresh(df, "h_host", "h_rate", "h_kept")
    verdict = verdict.select(F.col("host").alias(hn[0]), F.col("host_rate").alias(hn[1]), F.col("host_kept").alias(hn[2]))
    joined = df.join(verdict, c(host_col).eqNullSafe(c(hn[0])), "left")
    result = F.struct(c(q)["n_words"].alias("n_words"), c(q)["word_chars"].alias("word_chars"),
                      c(q)["n_symbols"].alias("n_symbols"), c(q)["n_lines"].alias("n_lines"),
                      c(q)["n_dup_lines"].alias("n_dup_lines"), c(q)["n_repeat_words"].alias("n_repeat_words"),
                      c(base).alias("base_failed"), c(hn[1]).alias("host_rate"), (~c(base) & c(hn[2])).alias("kept"))
    return joined.withColumn(out, result).drop(q, failed, base, *hn)


def _any(signals: str, rules: dict[str, str]) -> Column:
    found = F.lit(False)
    for rule in rules.values():
        found = found | _rule(signals, rule)
    return found
