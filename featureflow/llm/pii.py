"""Personal data by base patterns and bootstrapped contextual extraction. DataFrame functions only.

Base spans are checked regular expressions. The bootstrap then takes them as seed entities: the words
on an entity's left are a lexical pattern; patterns and instances (identifier-like strings) form a
bipartite graph that Spark scores in rounds: a pattern is as good as the share of its distinct
instances that are believed, an instance as good as its best pattern; patterns with enough distinct
seeds and a high score find identifiers that no base expression covers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from featureflow.llm.common import c, fresh, let, stored, text_of

KINDS = ("email", "ip", "card", "phone")

# The base expressions, written so that Java's engine stays linear on very long runs: a run of name
# characters or digits is only tried from its start or from the end of the last match, and repeats
# that nothing follows are possessive. Both leave the matches as they are.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINT = {"email": "@", "phone": "+"}  # a text without it has no match
OCTET = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"

# A token that may be an identifier: it holds a digit or an at sign.
TOKEN = r"(?<![^\x20\x09-\x0D])[^0-9@\x20\x09-\x0D]*+[0-9@][^\x20\x09-\x0D]*+"
# Adjacent tokens of digits, brackets, dots and dashes that may be one identifier.
PART = r"[(\[]?+[0-9][0-9()\[\].-]*+(?=[\x20\x09-\x0D,;:!?\"'>}]|$)"
GROUP = rf"(?<![^\x20\x09-\x0D])[\"'<{{]*+{PART}(?:\x20{PART})++"
LEAD = r"^[\"'<{]++|^[\"'(\[<{]++(?![0-9]++[)\]].)"  # the bracket of an area code stays
EDGE = r"^[\"'(\[<{]++|(?<![\"')\]>}.,;:!?])[\"')\]>}.,;:!?]++$"

CONTEXT_CHARS = 64  # code points on the left in which a pattern's words are looked for
MIN_SEEDS = 5       # distinct seed entities that a pattern needs
MIN_SCORE = 0.8     # score from which patterns discover and instances count as found
PRIOR = 1.0         # disbelieved instances added to every pattern
MIN_DIGITS = 4      # digits an unseen identifier has (or an at sign)
ROUNDS = 3


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike(OCTET))
    if kind == "phone":
        return F.length(F.translate(m, "+ ().-", "")).between(8, 15)
    if kind == "card":
        d = F.reverse(F.translate(m, " -", ""))
        digit = lambda i: F.substring(d, i, F.lit(1)).cast("int")
        twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        luhn = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0),
                           lambda a, i: a + F.when(i % 2 == 0, twice(digit(i))).otherwise(digit(i)))
        return F.when(F.length(d).between(16, 19), luhn % 10 == 0).otherwise(F.lit(False))
    return F.lit(True)


def _checked(kind: str):
    return lambda x: _valid(kind, x["m"])


SPAN = "struct<s:int,e:int,m:string,b:string>"  # start, end, match, the text just before it
CHUNK = 128   # items whose results one array grows by before it is put aside: a fold copies what it has at every step
BLOCK = 1024  # code points of a piece of text that a cut reads


def _fold(items: Column, state: dict[str, Column], step, kind: str) -> Column:
    """The array of what ``step(state, item) -> (next state, output)`` puts out for one item after the other, ``kind`` its
    type. The items are folded chunk by chunk, so long arrays take time in proportion to their length."""
    def put(st, out):
        return F.struct(*[st[k].alias(k) for k in state], out.alias("out"))

    def one(a, x):
        st, out = step(a, x)
        return put(st, F.concat(a["out"], F.array(out)))

    def chunk(part, a):
        return F.aggregate(part, put(a, F.array().cast(f"array<{kind}>")), one)

    def whole(it):
        start = put(state, F.array().cast(f"array<array<{kind}>>"))
        at = F.sequence(F.lit(1), F.size(it), F.lit(CHUNK))
        return F.flatten(F.aggregate(at, start, lambda a, i: let(chunk(F.slice(it, i, F.lit(CHUNK)), a), lambda r: put(r, F.concat(a["out"], F.array(r["out"])))),
                                     lambda a: a["out"]))
    return let(items, lambda it: F.when(F.size(it) > 0, whole(it)).otherwise(F.array().cast(f"array<{kind}>")))


def _tail(*parts: Column) -> Column:
    return F.substring(F.concat(*parts), -CONTEXT_CHARS, CONTEXT_CHARS)


def _spans(text: Column, rx: str, found: Column, keep) -> Column:
    """Spans (s, e, m, b) in code points of the matches ``found`` of ``rx``: the gaps between the matches (the text split by
    the expression) give the offsets and the text before each."""
    def step(a, x):
        s = a["at"] + F.length(x["g"])
        e = s + F.length(x["m"])
        before = _tail(a["tail"], x["g"])
        return {"at": e, "tail": _tail(a["tail"], x["g"], x["m"])}, F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"), before.alias("b"))
    gaps = F.split(text, rx, -1)
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("g"), found.alias("m"))
    folded = _fold(pairs, {"at": F.lit(0), "tail": F.lit("")}, step, SPAN)
    return F.when(F.size(found) > 0, F.filter(folded, keep)).otherwise(F.array().cast(f"array<{SPAN}>"))


def _apart(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that overlap none of ``others``: both are sorted by start and walked forth, keeping how far others
    reach, and back, keeping where the next one starts."""
    row = "struct<s:int,c:int,e:int,m:string,b:string,ok:boolean>"
    none = F.lit(None).cast("string")

    def rows(col, no, m, b):
        return F.transform(col, lambda x: F.struct(x["s"].alias("s"), F.lit(no).alias("c"), x["e"].alias("e"), m(x).alias("m"), b(x).alias("b"),
                                                   F.lit(True).alias("ok")))

    def marked(x, ok):
        return F.struct(*[x[k].alias(k) for k in ("s", "c", "e", "m", "b")], (x["ok"] & ((x["c"] == 0) | ok)).alias("ok"))
    both = F.array_sort(F.concat(rows(others, 0, lambda x: none, lambda x: none), rows(spans, 1, lambda x: x["m"], lambda x: x["b"])))
    forth = _fold(both, {"reach": F.lit(0)}, lambda a, x: (
        {"reach": F.when(x["c"] == 0, F.greatest(a["reach"], x["e"])).otherwise(a["reach"])}, marked(x, a["reach"] <= x["s"])), row)
    back = _fold(F.reverse(forth), {"next": F.lit(2**31 - 1)}, lambda a, x: (
        {"next": F.when(x["c"] == 0, x["s"]).otherwise(a["next"])}, marked(x, a["next"] >= x["e"])), row)
    free = F.transform(F.filter(F.reverse(back), lambda x: (x["c"] == 1) & x["ok"]),
                       lambda x: F.struct(*[x[k].alias(k) for k in ("s", "e", "m", "b")]))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), free).otherwise(spans)


def _norm(words: Column) -> Column:
    return F.regexp_replace(F.lower(words), "[0-9]", "0")


def _patterns(before: Column, start: Column) -> Column:
    """Left-context patterns of a code point position from the text before it (its last CONTEXT_CHARS): the last word, and
    the last two words. A word cut by the window's edge is no pattern; the text's start is the word ^."""
    w = F.split(F.concat(F.when(start < CONTEXT_CHARS, F.lit("^ ")).otherwise(F.lit("")), before), r"[\x20\x09-\x0D]+")
    w = F.filter(w, lambda x: x != "")
    return let(w, lambda v: _last_words(v, start))


def _last_words(w: Column, start: Column) -> Column:
    one = F.when((F.size(w) >= 2) | (start < CONTEXT_CHARS), F.element_at(w, -1))
    two = F.when((F.size(w) >= 3) | ((F.size(w) == 2) & (start < CONTEXT_CHARS)),
                 F.concat(F.get(w, F.size(w) - 2), F.lit(" "), F.get(w, F.size(w) - 1)))
    return F.filter(F.array(_norm(one), _norm(two)), lambda x: x.isNotNull())


def scan(docs: DataFrame, text_col: str, prefix: list[str], keep_text: bool = True) -> DataFrame:
    """Adds, under the three free names ``prefix``, a row key, ``base`` (kind, s, e, m, ctx) and ``cand`` (s, e, m, ctx):
    identifier-like tokens outside the base spans. Written to the shared folder, which also fixes the row keys."""
    rid, base, cand = prefix
    t = text_of(c(text_col))
    found = fresh(docs.select("*", *[F.lit(0).alias(p) for p in prefix]), *[f"m_{k}" for k in KINDS], "m_tok", "m_group")
    spans = fresh(docs.select("*", *[F.lit(0).alias(p) for p in (*prefix, *found)]), *[f"s_{k}" for k in KINDS], "s_tok", "s_group")
    d = docs
    for k, m in zip(KINDS, found, strict=False):
        got = F.regexp_extract_all(t, F.lit(BASE[k]), F.lit(0))
        if k in HINT:
            got = F.when(F.instr(t, HINT[k]) > 0, got).otherwise(F.array().cast("array<string>"))
        d = d.withColumn(m, got)
    for rx, m in zip((TOKEN, GROUP), found[-2:], strict=True):
        d = d.withColumn(m, F.regexp_extract_all(t, F.lit(rx), F.lit(0)))
    for k, m, s in zip(KINDS, found, spans, strict=False):
        d = d.withColumn(s, _spans(t, BASE[k], c(m), _checked(k)))
    for rx, m, s in zip((TOKEN, GROUP), found[-2:], spans[-2:], strict=True):
        d = d.withColumn(s, _spans(t, rx, c(m), lambda x: F.lit(True)))
    ctx = lambda x: _patterns(x["b"], x["s"]).alias("ctx")

    def named(kind):
        return lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), ctx(x))
    allb = F.concat(*[F.transform(c(s), named(k)) for k, s in zip(KINDS, spans, strict=False)])
    d = d.withColumn(base, allb)

    def trimmed(lead_rx):
        def trim(x):
            core = F.regexp_replace(x["m"], lead_rx, "")
            lead = F.length(x["m"]) - F.length(core)
            core = F.regexp_replace(core, EDGE[EDGE.index("|") + 1:], "")
            at = x["s"] + lead
            return F.struct(at.alias("s"), (at + F.length(core)).alias("e"), core.alias("m"), _tail(x["b"], F.substring(x["m"], F.lit(1), lead)).alias("b"))
        return trim
    long = lambda x: (F.length(F.regexp_replace(x["m"], "[^0-9]", "")) >= MIN_DIGITS) | x["m"].contains("@")
    free = lambda col, rx: _apart(F.filter(F.transform(col, trimmed(rx)), long), c(base))
    d = d.withColumn(spans[-1], free(c(spans[-1]), LEAD))
    d = d.withColumn(spans[-2], free(c(spans[-2]), EDGE[:EDGE.index("|")]))
    free = F.concat(c(spans[-1]), _apart(c(spans[-2]), c(spans[-1])))  # a group is one candidate
    d = d.withColumn(cand, F.transform(free, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), ctx(x))))
    d = d.drop(*found, *spans) if keep_text else d.drop(*found, *spans, text_col)
    return stored(d.withColumn(rid, F.monotonically_increasing_id()), "pii-scan")


def bootstrap(scanned: DataFrame, base: str, cand: str, rounds: int = ROUNDS) -> DataFrame:
    """Confident patterns (ctx, kind, score) from the pattern-instance graph of the scanned table."""
    seeds = scanned.select(F.explode(c(base)).alias("b")).select(F.explode("b.ctx").alias("ctx"), F.col("b.kind").alias("kind"), F.lower("b.m").alias("inst"))
    other = scanned.select(F.explode(c(cand)).alias("b")).select(F.explode("b.ctx").alias("ctx"), F.lit("").alias("kind"), F.lower("b.m").alias("inst"))
    edges = stored(seeds.unionByName(other).distinct(), "pii-edges")
    sizes = edges.groupBy("ctx").agg(F.count(F.lit(1)).alias("n"))
    base_seeds = edges.where("kind <> ''").groupBy("ctx", "kind").agg(F.count(F.lit(1)).alias("seeds"), F.count(F.lit(1)).cast("double").alias("mass"))
    believed, scores = None, None
    unseen = edges.where("kind = ''").select("ctx", "inst")
    for _ in range(rounds):
        seen = base_seeds
        if believed is not None:  # confident instances of the last round are seeds too
            got = unseen.join(believed, "inst").groupBy("ctx", "kind").agg(F.count(F.lit(1)).alias("seeds"), F.sum("belief").alias("mass"))
            seen = seen.unionByName(got).groupBy("ctx", "kind").agg(F.sum("seeds").alias("seeds"), F.sum("mass").alias("mass"))
        score = seen.where(F.col("seeds") >= MIN_SEEDS).join(sizes, "ctx")
        scores = stored(score.select("ctx", "kind", (F.col("mass") / (F.col("n") + F.lit(PRIOR))).alias("score")), "pii-scores")
        believed = (unseen.join(scores.where(F.col("score") >= MIN_SCORE), "ctx").groupBy("inst", "kind").agg(F.max("score").alias("belief")))
    return scores.where(F.col("score") >= MIN_SCORE)


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii", keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct ``out``: base and spans, arrays of (kind no, s, e) in code points, end exclusive,
    by kind (KINDS order), then start; spans holds the base spans and the discovered ones.

    Null and empty texts have no spans; repeated rows each get theirs; ids play no part, so null or
    repeated ids are fine; an empty table gives an empty result; input columns keep their names (``out``
    must be free). A span found by patterns of two kinds gets the kind of the higher score, ties the
    earlier kind. Hot patterns only meet joins and partial aggregates, which Spark can split.
    """
    if out.lower() in (n.lower() for n in docs.columns):
        raise ValueError(f"column {out} exists")
    *names, hit_rid, add = fresh(docs, "row_", "base_", "cand_", "rid_", "add_")
    rid, base, cand = names
    d = scan(docs, text_col, names, keep_text)
    patterns = bootstrap(d, base, cand)
    occ = d.select(c(rid).alias("rid_"), F.explode(c(cand)).alias("x")).select("rid_", "x.s", "x.e", F.explode("x.ctx").alias("ctx"))
    no = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    hits = occ.join(patterns, "ctx").select("rid_", "s", "e", F.struct((-F.col("score")).alias("o"), no.alias("k")).alias("best"))
    hits = hits.groupBy("rid_", "s", "e").agg(F.min("best").alias("best"))
    added = hits.groupBy("rid_").agg(F.collect_list(F.struct(F.col("best.k").alias("k"), "s", "e")).alias(add)).withColumnRenamed("rid_", hit_rid)
    d = d.join(added, c(rid) == c(hit_rid), "left")
    kind_no = lambda k: (F.array_position(F.array(*[F.lit(x) for x in KINDS]), k).cast("int") - 1)
    b = F.array_sort(F.transform(c(base), lambda x: F.struct(kind_no(x["kind"]).alias("k"), x["s"].alias("s"), x["e"].alias("e"))))
    res = F.struct(b.alias("base"), F.array_sort(F.concat(b, F.coalesce(c(add), F.array().cast("array<struct<k:int,s:int,e:int>>")))).alias("spans"))
    return d.withColumn(out, res).drop(rid, base, cand, hit_rid, add)


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by <KIND>; where spans overlap, the first one names the place."""
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    t = text_of(text)
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))

    def cut(blocks, lo, hi):  # code points lo to hi, read from their blocks alone
        first = F.floor(lo / BLOCK).cast("int")
        n = F.greatest(F.lit(0), F.ceil(hi / BLOCK).cast("int") - first)
        return F.substring(F.array_join(F.slice(blocks, first + 1, n), ""), lo - first * BLOCK + 1, F.greatest(F.lit(0), hi - lo))

    def replaced(blocks):
        def step(a, x):
            piece = F.when(x["s"] >= a["at"], F.concat(cut(blocks, a["at"], x["s"]), F.get(tags, x["k"]))).otherwise(F.lit(""))
            return {"at": F.greatest(a["at"], x["e"])}, piece
        return F.array_join(_fold(order, {"at": F.lit(0)}, step, "string"), "")
    last = F.array_max(F.transform(spans, lambda x: x["e"]))
    done = F.concat(let(F.regexp_extract_all(t, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), replaced), F.substring(t, last + 1, F.length(t)))
    return F.when(F.size(spans) > 0, done).otherwise(text)
