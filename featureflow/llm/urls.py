"""URL filters: rules indexed by their rarest literal token. DataFrame functions only.

Every rule has a regular expression and literal tokens that a fitting URL must hold. One pass counts in how
many URLs each of the rules' tokens occurs; a rule is filed under its rarest token. A URL's tokens then fetch
its candidate rules, and only those run their expression.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from featureflow.llm.common import LiteralMap, ascii_lower, c, fresh, let


@dataclass(frozen=True)
class Rule:
    """``name`` as reported; ``pattern`` runs on host + path; ``tokens``: maximal runs of a-z and 0-9 that every
    fitting lower-cased host + path holds; ``site`` rules go before others, the longest name first."""
    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    site: bool = False


def site_rule(verdict: str, rule: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the URL's path starts with the rule's path."""
    host, slash, rest = rule.partition("/")
    pattern = r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(slash + rest)
    whole = rule if not rest or not rest[-1].isalnum() else rule[: len(rule) - len(re.split(r"[^A-Za-z0-9]", rule)[-1])]
    return Rule(rule, pattern, tuple(t for t in re.split("[^a-z0-9]+", whole.lower()) if t), verdict, True)


def word_rule(*parts: str) -> Rule:
    """Blocks hosts and paths that hold the words next to each other, joined by - _ or +."""
    joined = "[-_+]".join(map(re.escape, parts))
    return Rule(" ".join(parts), rf"(?i)(?:^|[^a-z0-9]){joined}(?:[^a-z0-9]|$)", parts, "block")


# The method's own rules beside the site rules a caller gives.
WORD_RULES = [word_rule(*x.split()) for x in (
    "casino", "poker", "cheap pills", "online pharmacy", "viagra", "adult x", "xxx", "porn", "spam farm", "link farm",
    "free followers", "payday loans")]


ALWAYS = "*"  # stands for a token that all URLs have


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null and without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end up to ? or # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(df: DataFrame, url_col: str, rules: list[Rule], out: str = "judged") -> DataFrame:
    """``df`` with a struct ``out``: host, path, rule (the longest fitting site rule, else null) and verdict: that
    rule's, else block if another rule fits, else allow. Of fitting site rules of one length the greatest name wins.

    The rules are a parameter, so the index and the rules' token counts have a bounded size; the counts cover all
    rows. Each row is judged where it stands: repeated rows, ties, null ids and extra columns don't matter. Null
    URLs and those without :// have empty host and path and fit no site rule; an empty table gives an empty result.
    """
    if out.lower() in (n.lower() for n in df.columns):
        raise ValueError(f"column {out} exists")
    h, p, tk = fresh(df, "host_", "path_", "tokens_")
    url = c(url_col).cast("string")
    d = df.withColumn(h, host_of(url)).withColumn(p, path_of(url))
    d = d.withColumn(tk, F.array_distinct(F.concat(F.split(ascii_lower(F.concat(c(h), c(p))), "[^a-z0-9]+"), F.array(F.lit(ALWAYS)))))
    known = sorted({t for r in rules for t in r.tokens})
    named = F.from_json(F.lit(json.dumps(known)), "array<string>")
    counts = d.select(F.explode(F.array_intersect(c(tk), named)).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    n = {r.t: r.n for r in counts.collect()}  # one row a rule token at most
    filed: dict[str, list] = {}
    for r in rules:  # a rule without a token runs on every URL
        rarest = min(r.tokens, key=lambda t: (n.get(t, 0), t), default=ALWAYS)
        filed.setdefault(rarest, []).append(
            {"site": r.site, "size": len(r.name), "name": r.name, "verdict": r.verdict, "pattern": r.pattern})
    index = LiteralMap(filed, "array<struct<site:boolean,size:int,name:string,verdict:string,pattern:string>>")
    place = F.concat(c(h), c(p))

    def fitting(table):
        fetched = F.flatten(F.filter(F.transform(c(tk), lambda t: index.get(table, t)), lambda x: x.isNotNull()))
        return F.filter(fetched, lambda r: F.regexp_like(place, r["pattern"]))
    (fit,) = fresh(d, "fit_")
    d = d.withColumn(fit, let(index.table, fitting))
    best = F.array_max(F.transform(F.filter(c(fit), lambda r: r["site"]), lambda r: F.struct(r["size"], r["name"], r["verdict"])))
    other = F.when(F.exists(c(fit), lambda r: ~r["site"] & (r["verdict"] == "block")), F.lit("block")).otherwise(F.lit("allow"))
    d = d.withColumn(fit, F.struct(best.alias("best"), other.alias("other")))
    res = F.struct(c(h).alias("host"), c(p).alias("path"), c(fit)["best"]["name"].alias("rule"),
                   F.coalesce(c(fit)["best"]["verdict"], c(fit)["other"]).alias("verdict"))
    return d.withColumn(out, res).drop(h, p, tk, fit)
