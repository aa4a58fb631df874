"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

Document rates r minimise the entropy distance sum(size * (r log r - r + 1)) from taking every word once, at most
``cap`` each, subject to one token constraint a source, sum(size * r) = target, and one over all sources: words of
the mix lie in texts as long as those of the corpus (the mean size class of a word stays), as near as a quadratic
penalty allows. The dual's multipliers give r = min(cap, exp(lambda of the source + mu * size class)), so documents
of one source are tilted by length. The length multiplier couples all sources: a Newton step needs sums over all of
them, which Spark aggregates from the distributed table of sources and their size classes. Rates are then rounded
into whole copies, evenly along each source's documents in order of size, so that taken words follow the target far
closer than independent draws would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from featureflow.llm.common import c, fresh, n_words, stored

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
NEWTON_STEPS = 30
PENALTY = 0.05  # weight of the squared length multiplier against a word; keeps constraints that can't be met finite
FULL = 1e3      # multiplier of a source that is taken cap times
SLICE_ROWS = 2_000  # rows of a source and size class in one window, about


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """sizes: one row per source (source, source_size). Adds ``target``: the sources in code point order,
    null last, have ``weights`` in turn and share the sum of all sizes; a target stops at ``cap`` times
    its source's size and the excess is shared again by weight until none is above.

    Sharing again is water-filling: with sources in order of cap * size / weight, those before some place
    are full and the rest share what is left by weight. Both running sums are taken in two levels, over
    ranges and within them, so no task holds all sources."""
    ranked = _running(sizes, [F.col("source").isNull().cast("int"), F.col("source")], {"pos": F.lit(1)})
    turn = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("pos") - 1, F.lit(len(weights))).cast("int") + 1)
    t = ranked.select("source", "source_size", turn.alias("weight"))
    t = stored(t.withColumn("full", F.col("source_size") * cap).withColumn("level", F.col("full") / F.col("weight")), "mix-weights")
    s = t.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, all_w = float(s["size"] or 0), float(s["weight"] or 0)
    run = _running(t, [F.col("level"), F.col("source").isNull().cast("int"), F.col("source")],
                   {"full_to": F.col("full"), "w_to": F.col("weight")})
    before_full, before_w = F.col("full_to") - F.col("full"), F.col("w_to") - F.col("weight")
    share = F.when(F.lit(all_w) > before_w, (F.lit(total) - before_full) / (F.lit(all_w) - before_w))
    run = stored(run.withColumn("capped", F.coalesce(F.col("level") <= share, F.lit(True))), "mix-levels")
    f = run.where("capped").agg(F.sum("full").alias("full"), F.sum("weight").alias("weight")).first()
    rest_w = all_w - float(f["weight"] or 0)
    rest = (total - float(f["full"] or 0)) / rest_w if rest_w > 0 else 0.0
    target = F.when(F.col("capped"), F.col("full").cast("double")).otherwise(F.col("weight") * F.lit(rest))
    return run.select("source", "source_size", "weight", target.alias("target"))


def _running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with inclusive running sums in ``order`` over the whole table: range partitions are summed
    first, and the partition totals are carried into each. ``order`` must be total."""
    part, *vals = fresh(df, "part_", *[f"v{i}_" for i in range(len(sums))])
    keys = fresh(df, *[f"o{i}_" for i in range(len(order))])
    d = df.select("*", *[o.alias(k) for o, k in zip(order, keys, strict=True)], *[v.alias(n) for v, n in zip(sums.values(), vals, strict=True)])
    d = stored(d.repartitionByRange(*[c(k) for k in keys]).withColumn(part, F.spark_partition_id()), "mix-ranges")
    inside = W.partitionBy(part).orderBy(*[c(k) for k in keys]).rowsBetween(W.unboundedPreceding, 0)
    totals = d.groupBy(part).agg(*[F.sum(c(v)).alias(v) for v in vals])  # one row per partition
    upto = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(F.col(part).alias("at_"), *[F.coalesce(F.sum(c(v)).over(upto), F.lit(0)).alias("b_" + v) for v in vals])
    d = d.select("*", *[F.sum(c(v)).over(inside).alias("r_" + v) for v in vals])
    d = d.join(offsets, c(part) == F.col("at_"), "left")
    return d.select(*[c(n) for n in df.columns], *[(c("r_" + v) + c("b_" + v)).alias(n) for v, n in zip(vals, sums, strict=True)])


def _class_groups(slim: DataFrame, source_col: str, cls: str, size: str) -> DataFrame:
    """(source, class, n, words): documents and words of each size class."""
    return slim.groupBy(c(source_col).alias("source"), c(cls).alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(c(size)).cast("double").alias("words"))


def solve_rates(groups: DataFrame, targets: DataFrame, cap: int = MAX_COPIES, steps: int = NEWTON_STEPS) -> DataFrame:
    """(source, source_size, target, classes), one row a source, ``classes`` with the ``rate`` of each size class.

    groups: (source, class, n, words), a source has about 4 * 31 classes at most. Newton's equations have one row a
    source, each tied to the length multiplier only, so eliminating the sources leaves one number for that: a sum
    over all sources. Each step is one distributed pass; the driver sees five sums. Steps are limited to [-1, 1]; the
    source constraints are met exactly at the end, whatever the steps have reached. Sources without words or target
    have rate 0."""
    s = groups.agg(*[F.sum(F.col("words") * F.pow("class", F.lit(i))).alias(f"m{i}") for i in range(3)]).first()
    words = s["m0"] or 0.0
    mean = s["m1"] / words if words else 0.0
    sd = max(s["m2"] / words - mean * mean, 0.0) ** 0.5 if words else 0.0
    x = (F.col("class") - F.lit(mean)) / F.lit(sd) if sd > 1e-9 else F.lit(0.0)
    per = groups.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("class", "n", "words", x.alias("x")))).alias("classes"))
    per = per.withColumnRenamed("source", "gs").join(targets, F.col("gs").eqNullSafe(F.col("source"))).drop("gs")
    ok = (F.col("source_size") > 0) & (F.col("target") > 0)
    full = F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)
    start = F.when(ok, F.when(full, F.lit(FULL)).otherwise(F.log(F.col("target") / F.col("source_size"))))
    state, mu, done = per.withColumn("lam", start), 0.0, words == 0.0 or sd <= 1e-9
    for _ in range(0 if done else steps):
        state = stored(state.withColumn("s", _sums(F.col("lam"), F.lit(mu), cap)), "mix-dual")
        gap = F.when(F.col("lam") < FULL, F.col("target") - F.col("s.f")).otherwise(F.lit(0.0))
        free = F.when(F.col("s.a") > 0, F.col("s.a"))
        t = state.where("lam is not null").agg(
            F.sum("s.g").alias("g"), F.sum(F.col("s.b") * gap / free).alias("bg"),
            F.sum(F.col("s.c") - F.col("s.b") * F.col("s.b") / free).alias("h"),
            F.max(F.abs(gap) / F.col("target")).alias("off")).first()
        rest = -PENALTY * words * mu - (t["g"] or 0.0)
        if abs(rest) <= 1e-9 * words and (t["off"] or 0.0) <= 1e-9:
            break
        by = max(-1.0, min(1.0, (rest - (t["bg"] or 0.0)) / (PENALTY * words + (t["h"] or 0.0))))
        step = F.coalesce((gap - F.col("s.b") * F.lit(by)) / free, F.when(gap < 0, F.lit(-1.0)).otherwise(F.lit(0.0)))
        step = F.when(F.col("lam") < FULL, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), step))).otherwise(F.lit(0.0))
        state, mu = state.withColumn("lam", F.col("lam") + step).drop("s"), mu + by
    tilt = lambda x: F.exp(F.lit(mu) * x["x"])
    u = F.when(F.col("lam") < FULL, _exact(tilt, cap)).otherwise(F.lit(float("inf")))
    state = state.withColumn("u", F.when(F.col("lam").isNotNull(), u).otherwise(F.lit(0.0)))
    rated = F.transform("classes", lambda x: F.struct(x["class"].alias("class"), x["n"].alias("n"), x["words"].alias("words"),
                                                      F.least(F.lit(float(cap)), F.col("u") * tilt(x)).alias("rate")))
    return state.select("source", "source_size", "target", rated.alias("classes"))


def _sums(lam: Column, mu: Column, cap: int) -> Column:
    """Of a source: words taken (f) and their classes (g); the same of rates below the cap (a, b) and squares (c)."""
    def add(s, x):
        r = F.least(F.lit(float(cap)), F.exp(lam + mu * x["x"]))
        w = x["words"] * r
        free = F.when(r < cap, w).otherwise(F.lit(0.0))
        return F.struct((s["f"] + w).alias("f"), (s["g"] + w * x["x"]).alias("g"), (s["a"] + free).alias("a"),
                        (s["b"] + free * x["x"]).alias("b"), (s["c"] + free * x["x"] * x["x"]).alias("c"))
    return F.aggregate("classes", F.struct(*[F.lit(0.0).alias(n) for n in "fgabc"]), add)


def _exact(tilt, cap: int) -> Column:
    """The factor u = exp(lambda) that meets a source's target: sum(words * min(cap, u * tilt)) is concave and
    piecewise linear in u, so Newton steps from 0 only grow and pass at least one class each."""
    def grow(u, _):
        def add(s, x):
            r = u * tilt(x)
            return F.struct((s["f"] + x["words"] * F.least(F.lit(float(cap)), r)).alias("f"),
                            (s["a"] + F.when(r < cap, x["words"] * tilt(x)).otherwise(F.lit(0.0))).alias("a"))
        s = F.aggregate("classes", F.struct(F.lit(0.0).alias("f"), F.lit(0.0).alias("a")), add)
        return u + F.when(s["a"] > 0, F.greatest(F.lit(0.0), (F.col("target") - s["f"]) / s["a"])).otherwise(F.lit(0.0))
    return F.aggregate(F.sequence(F.lit(1), F.size("classes") + 1), F.lit(0.0), grow)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS,
        cap: int = MAX_COPIES, out: str = "mix", keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct ``out``: size, source_size, target, rate, copies, taken.

    Every copy count is floor(rate) or one more and at most ``cap``. How many documents get one more is set
    by size class from long to short texts, each handing on what rounding left open; within a class every
    (n / extra)-th document is chosen. Positions come from counts of (source, class, salt) groups, so a hot source or a hot size never meets in one window. Counts depend on the rows' content only: reruns agree.
    Null texts have size 0; null sources are one source; repeated rows each count and rows that are alike
    in all columns (but maps and variants) are told apart by position alone; an empty table gives an empty result.
    """
    if out.lower() in (n.lower() for n in docs.columns):
        raise ValueError(f"column {out} exists")
    size, h, cls, salt, src, rate, lim, sl, pos, ex = fresh(
        docs, "size_", "hash_", "class_", "salt_", "src_", "rate_", "lim_", "slice_", "pos_", "extra_")
    d = docs.withColumn(size, n_words(c(text_col)))
    hashed = [n for n, kind in docs.dtypes if "map<" not in kind and "variant" not in kind and n not in (id_col, text_col)]
    d = d.withColumn(h, F.xxhash64(c(id_col), c(size), F.xxhash64(c(text_col)), *[c(n) for n in hashed]))
    d = d.withColumn(cls, F.floor(F.log2(c(size) + F.lit(1.0)) * 4).cast("int"))
    slim = stored(d.select(c(source_col), c(size), c(h), c(cls)), "mix-sizes")  # without texts
    d = d if keep_text else d.drop(text_col)
    groups = stored(_class_groups(slim, source_col, cls, size), "mix-groups")
    sums = stored(groups.groupBy("source").agg(F.sum("words").cast("long").alias("source_size")), "mix-sources")
    rates = stored(solve_rates(groups, source_targets(sums, weights, cap), cap), "mix-rates")
    plan = stored(_class_plan(rates, cap), "mix-classes")
    side = rates.select(F.col("source").alias(src), F.col("target").alias(lim), F.col("source_size").alias(sl))
    d = d.join(side, c(source_col).eqNullSafe(c(src)), "left").drop(src)
    d = _choose(d, slim, plan, source_col, size, h, cls, salt, pos, ex, rate)
    copies = F.least(F.floor(c(rate) + F.lit(1e-9)) + c(ex), F.lit(cap)).cast("long")
    res = F.struct(c(size).alias("size"), c(sl).alias("source_size"), c(lim).alias("target"), c(rate).alias("rate"),
                   copies.alias("copies"), (copies * c(size)).alias("taken"))
    return d.withColumn(out, res).drop(size, h, cls, salt, rate, lim, sl, pos, ex)


def _class_plan(rates: DataFrame, cap: int) -> DataFrame:
    """(source, class, n, slices, extra, rate): how many of the n documents of a size class get one copy more than
    floor(rate). Classes go from long to short texts and hand on what rounding left open, so a source's words end
    near its target; a class that is taken ``cap`` times gives none."""
    kind = "array<struct<class:int,n:bigint,slices:int,extra:bigint,rate:double>>"

    def step(a, x):
        floor = F.floor(x["rate"] + F.lit(1e-9))
        mean, want = x["words"] / x["n"], F.greatest(x["rate"] - floor, F.lit(0.0)) * x["words"] + a["open"]
        k = F.when((mean > 0) & (floor < cap), F.least(F.greatest(F.round(want / mean), F.lit(0.0)), x["n"].cast("double"))).otherwise(F.lit(0.0))
        row = F.struct(x["class"].alias("class"), x["n"].alias("n"), F.ceil(x["n"] / SLICE_ROWS).cast("int").alias("slices"),
                       k.cast("long").alias("extra"), x["rate"].alias("rate"))
        return F.struct((want - k * mean).alias("open"), F.concat(a["rows"], F.array(row)).alias("rows"))
    rows = F.aggregate(F.reverse("classes"), F.struct(F.lit(0.0).alias("open"), F.array().cast(kind).alias("rows")), step, lambda a: a["rows"])
    return rates.select("source", F.explode(rows).alias("x")).select("source", "x.*")


def _choose(d: DataFrame, slim: DataFrame, plan: DataFrame, source_col: str, size: str, h: str, cls: str, salt: str, pos: str, ex: str,
            rate: str) -> DataFrame:
    """Adds ``rate`` and ``ex`` (0 or 1): every (n / extra)-th document of a size class, along (salt, size, hash)."""
    s1, c1, n1, sl1, k1, s2, c2, t2, before = fresh(d, "s1_", "c1_", "n1_", "sl1_", "k1_", "s2_", "c2_", "t2_", "before_")

    def salted(x):
        x = x.join(plan.toDF(s1, c1, n1, sl1, k1, rate), c(source_col).eqNullSafe(c(s1)) & (c(cls) == c(c1)), "left")
        return x.withColumn(salt, F.pmod(F.xxhash64(c(h), F.lit(7)), c(sl1)).cast("int"))
    n = salted(slim).groupBy(c(source_col).alias(s2), c(cls).alias(c2), c(salt).alias(t2)).agg(F.count(F.lit(1)).alias("n"))
    ahead = W.partitionBy(c(s2), c(c2)).orderBy(c(t2)).rowsBetween(W.unboundedPreceding, -1)
    n = n.select(c(s2), c(c2), c(t2), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias(before))
    n = stored(n, "mix-slices")  # its size is known before the join, so the texts aren't dealt out a second time for it
    d = salted(d).withColumn(pos, F.row_number().over(W.partitionBy(c(source_col), c(cls), c(salt)).orderBy(c(size), c(h))))
    d = d.join(n, c(source_col).eqNullSafe(c(s2)) & (c(cls) == c(c2)) & (c(salt) == c(t2)), "left")
    at = c(pos) + c(before)
    up = lambda x: F.floor(x * c(k1) / c(n1) + F.lit(1e-9))
    return d.withColumn(ex, (up(at) - up(at - 1)).cast("long")).drop(s1, c1, n1, sl1, k1, s2, c2, t2, before)
