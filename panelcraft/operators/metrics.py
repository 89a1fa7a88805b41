"""How useful a segmentation is: reach, signal, spread and uniqueness of its segments.

Inputs are the deliver table (questions x segments rows) and the responses. Every metric comes back as a
DataFrame with a ``cluster`` column, so that reports are unions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sampling import unit_hash
from ..roles import PLATFORM_MARKS, TARGET_MARK

# Fixed values of the metrics.
ALPHA = 0.05
MESSAGE_MARKS = "psy|ae"
SLICE_START, SLICE_FLOOR, SLICE_STEP, SLICE_CORE = 0.25, 0.15, 0.01, 6
HOLD_OUT = 0.33
TREES = 100
NAME_NOISE = ["tgt", "sbeh", "life", "mc", "uk", "cb", "ww", "gg", "ims", "fb"]
SIGNAL_FIELDS = ("signal", "precision", "recall_score", "f1_score")


def uniqueness(deliver: DataFrame) -> DataFrame:
    """1 - share of a segment's findings that another segment has with the same answers."""
    key = ["q_code", "sig_more_category"]
    shared = (deliver.groupBy(*key).agg(F.count_distinct("targeting_seg").alias("n_segments"))
              .filter("n_segments > 1").select(*key, F.lit(True).alias("shared")))
    return (deliver.join(shared, key, "left").groupBy(F.col("targeting_seg").alias("cluster"))
            .agg((1 - F.count_if("shared") / F.count(F.lit(1))).alias("uniqueness")))


def communicability(deliver: DataFrame) -> DataFrame:
    """Significant psychometric and creative questions per segment; the average is over all segments."""
    per = (deliver.filter(F.col("q_code").rlike(MESSAGE_MARKS))
           .groupBy(F.col("targeting_seg").alias("cluster"))
           .agg(F.count_distinct("q_code").cast("double").alias("communicability")))
    found = F.count_distinct(F.when(F.col("q_code").rlike(MESSAGE_MARKS), F.struct("targeting_seg", "q_code")))
    average = deliver.agg(F.try_divide(found, F.count_distinct("targeting_seg")).alias("communicability")).select(
        F.lit("average").alias("cluster"), "communicability")
    return per.unionByName(average)


def significant_counts(deliver: DataFrame, alpha: float = ALPHA) -> DataFrame:
    sig = deliver.filter(F.col("chi_2_result") <= alpha)
    return sig.groupBy(F.col("targeting_seg").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n_significant"),
        F.count_if(F.col("q_code").contains(TARGET_MARK)).alias("n_significant_tgt"))


def spread(deliver: DataFrame, alpha: float = ALPHA, targets_only: bool = False) -> DataFrame:
    """Per segment and question group: significant rows over the group's rows in all segments.

    Groups in which a segment has none are left out.
    """
    rows = deliver.filter(F.col("q_code").contains(TARGET_MARK)) if targets_only else deliver
    rows = rows.withColumn("question_group", F.split("q_code", "_")[0])
    per = rows.groupBy("question_group", F.col("targeting_seg").alias("cluster")).agg(
        F.count_if(F.col("chi_2_result") <= alpha).alias("n_sig"), F.count(F.lit(1)).alias("n_rows"))
    groups = per.groupBy("question_group").agg(F.sum("n_rows").alias("n_group"))
    return (per.filter("n_sig > 0").join(groups, "question_group")
            .select("cluster", "question_group", (F.col("n_sig") / F.col("n_group")).alias("spread")))


def platform_column(responses: DataFrame, columns: list[str], platform: str) -> str | None:
    """Last channel question with an answer naming the platform; one scan over the channel columns."""
    if not columns:
        return None
    row = responses.agg(*[F.bool_or(F.contains(F.lower(F.col(c).cast("string")), F.lit(platform.lower()))).alias(c)
                          for c in columns]).first()
    found = [c for c in columns if row[c]]
    return found[-1] if found else None


def social_presence(responses: DataFrame, columns: list[str], platform: str = "Facebook",
                    segment: str = "cluster") -> DataFrame | None:
    """Share of each segment whose answer is exactly the platform; none when no question names it."""
    column = platform_column(responses, columns, platform)
    if column is None:
        return None
    return responses.groupBy(F.col(segment).cast("string").alias("cluster")).agg(
        F.round(F.count_if(F.col(column) == platform) / F.count(F.lit(1)), 3).alias("presence"))


# --- signal of the chi-squared findings --------------------------------------------------------------


def slice_columns(deliver: DataFrame) -> dict[str, list[tuple[str, str]]]:
    """(question, mode) pairs to slice each segment by, strongest first.

    Targetable questions, or where a segment has none the platform questions. Size: questions x segments.
    """
    code = "unencoded_seg" if "unencoded_seg" in deliver.columns else "targeting_seg"
    rows = (deliver.select(F.col(code).alias("cluster"), "q_code", "pop_mode", "chi_2_result")
            .orderBy("cluster", "chi_2_result", "q_code").collect())
    out: dict[str, list[tuple[str, str]]] = {}
    for cluster in {r["cluster"] for r in rows}:
        own = [(r["q_code"], r["pop_mode"]) for r in rows if r["cluster"] == cluster]
        chosen = [p for p in own if "tgt" in p[0].lower()]
        if not chosen:
            facebook, google = PLATFORM_MARKS
            chosen = [p for p in own if google in p[0].lower()]
            chosen += [p for p in own if facebook in p[0].lower() and google not in p[0].lower()]
        out[cluster] = chosen
    return out


def core_slices(responses: DataFrame, pairs: dict[str, list[tuple[str, str]]], segment: str = "cluster",
                population: bool = False) -> DataFrame:
    """Greedy core columns per segment: filters that each leave enough rows.

    Respondents are reduced once to counts of hit patterns. A walk over the columns then needs one aggregate
    over the patterns per accepted filter, for all segments together: with the present filters fixed, the next
    column accepted is the first whose count passes. ``population`` slices all rows instead of the segment's.
    A segment without any pair has no filter: its slice is all of it and its core is empty.
    """
    spark = responses.sparkSession
    schema = "cluster string, core array<string>, n_slice long, n_slice_in long, retained double"
    own = F.col(segment).cast("string")
    everyone = {r["cluster"]: r["count"] for r in responses.groupBy(own.alias("cluster")).count().collect()}
    total = sum(everyone.values())
    pairs = {s: p for s, p in pairs.items() if p}
    share = SLICE_START
    while share >= SLICE_FLOOR:
        share -= SLICE_STEP
    bare = [(s, [], total if population else n, n, round(share, 6)) for s, n in everyone.items()
            if s is not None and s not in pairs]
    if not pairs:
        return spark.createDataFrame(sorted(bare), schema)

    def hit_array(cols: list[tuple[str, str]]):
        return F.array(*[F.coalesce(F.col(c) == m, F.lit(False)) for c, m in cols])

    if population:
        branches = F.array(*[F.struct(F.lit(s).alias("cluster"), F.coalesce(own == s, F.lit(False)).alias("inside"),
                                      hit_array(cols).alias("hits")) for s, cols in pairs.items()])
        hits = responses.select(F.explode(branches).alias("b")).select("b.*")
    else:
        chosen = F.coalesce(*[F.when(own == s, hit_array(cols)) for s, cols in pairs.items()])
        hits = responses.filter(own.isin(list(pairs))).select(own.alias("cluster"), F.lit(True).alias("inside"), chosen.alias("hits"))
    patterns = hits.groupBy("cluster", "hits", "inside").count().persist()
    sizes = {r["cluster"]: r["n"] for r in patterns.groupBy("cluster").agg(F.sum("count").alias("n")).collect()}
    state = {s: {"kept": set(), "core": [], "at": 0, "share": SLICE_START, "rows": sizes.get(s, 0),
                 "least": SLICE_START * sizes.get(s, 0), "done": False} for s in pairs}
    while not all(v["done"] for v in state.values()):
        open_segments = [s for s, v in state.items() if not v["done"]]
        keep = F.lit(False)
        for s in open_segments:
            inside = F.col("cluster") == s
            for j in state[s]["kept"]:
                inside = inside & F.get("hits", F.lit(j))
            keep = keep | inside
        counts = {(r["cluster"], r["pos"]): r["n"] for r in
                  patterns.filter(keep).select("cluster", "count", F.posexplode("hits"))
                  .groupBy("cluster", "pos").agg(F.sum(F.when(F.col("col"), F.col("count")).otherwise(0)).alias("n"))
                  .collect()}
        for s in open_segments:
            v, width = state[s], len(pairs[s])
            moved = False
            while not moved and not v["done"]:
                nxt = next((j for j in range(v["at"], width)
                            if (v["rows"] if j in v["kept"] else counts.get((s, j), 0)) >= v["least"]), None)
                if nxt is not None:
                    v["core"].append(pairs[s][nxt][0])
                    v["at"] = nxt + 1
                    if nxt not in v["kept"]:
                        v["kept"].add(nxt)
                        v["rows"] = counts.get((s, nxt), 0)
                        moved = True
                    continue
                v["share"] -= SLICE_STEP
                v["least"] = v["share"] * v["rows"]
                if len(v["core"]) >= SLICE_CORE or v["share"] < SLICE_FLOOR:
                    v["done"] = True
                else:
                    v["at"], v["core"] = 0, []
    keep = F.lit(False)
    for s, v in state.items():
        inside = F.col("cluster") == s
        for j in v["kept"]:
            inside = inside & F.get("hits", F.lit(j))
        keep = keep | inside
    final = {r["cluster"]: (r["n"], r["n_in"]) for r in patterns.filter(keep).groupBy("cluster").agg(
        F.sum("count").alias("n"), F.sum(F.when(F.col("inside"), F.col("count")).otherwise(0)).alias("n_in")).collect()}
    patterns.unpersist()
    rows = bare + [(s, v["core"], *final.get(s, (0, 0)), round(v["share"], 6)) for s, v in state.items()]
    return spark.createDataFrame(sorted(rows), schema)


def signal_fields(size: str, inside: str, segment: str, total: str) -> dict:
    """Accuracy, precision, recall and F1 of 'is in the slice' against 'is in the segment', three decimals."""
    tp, n, own, everyone = (F.col(c).cast("double") for c in (inside, size, segment, total))
    ok = tp > 0
    precision, recall = F.round(tp / n, 3), F.round(tp / own, 3)
    zero = F.lit(0.0)
    return {
        "signal": F.when(ok, F.round((tp + (everyone - own) - (n - tp)) / everyone, 3)).otherwise(zero),
        "precision": F.when(ok, precision).otherwise(zero),
        "recall_score": F.when(ok, recall).otherwise(zero),
        "f1_score": F.coalesce(F.when(ok, F.round(F.try_divide(2 * precision * recall, precision + recall), 3)), zero),
    }


def chi2_signal(sizes: DataFrame, slices: DataFrame | None = None) -> DataFrame:
    """Signal per segment; without slices every row counts as selected."""
    base = sizes.select("cluster", "n", F.sum("n").over(Window.partitionBy()).alias("total"))
    if slices is None:
        base = base.withColumns({"n_slice": F.col("total"), "n_slice_in": F.col("n")})
    else:
        base = base.join(slices.select("cluster", "n_slice", "n_slice_in"), "cluster", "left").na.fill(
            0, ["n_slice", "n_slice_in"])
    fields = signal_fields("n_slice", "n_slice_in", "n", "total")
    return base.select("cluster", *[fields[f].alias(f) for f in SIGNAL_FIELDS])


def message_reach(presence: DataFrame | None, signal: DataFrame) -> DataFrame | None:
    """Presence times signal; none when there is no presence."""
    if presence is None:
        return None
    return presence.join(signal, "cluster").select(
        "cluster", F.round(F.col("presence") * F.col("signal"), 3).alias("message_reach"))


# --- variability and magnitude -----------------------------------------------------------------------


def question_codes(targets: list[str]) -> list[str]:
    """Codes that tie checkbox columns together: the first run of four digits or more in each name, or, when a
    name has none, the longest word that neighbouring names share."""
    found = [re.search(r"\d{4,}", c) for c in targets]
    if all(found):
        return list(dict.fromkeys(m.group(0) for m in found))
    bare = []
    for name in targets:
        for noise in NAME_NOISE:
            name = name.replace(noise, "")
        bare.append(name.split("_"))
    words = set()
    for left, right in zip(bare, bare[1:]):
        common = [w for w in left if w in right]
        if not common:
            break
        longest = max(common, key=len)
        if len(longest) > 3:
            words.add(longest)
    return sorted(words)


def variability(encoded: DataFrame, segment: str = "cluster") -> DataFrame | None:
    """Mean heterogeneity of the checkbox groups, overall and per segment.

    One pass takes column sums and squared row sums of every group; Cochran's Q and the share of it beyond its
    degrees of freedom follow from those. Undefined and non-positive shares are left out of the mean.
    """
    targets = [c for c in encoded.columns if "tgt" in c.lower()]
    if not targets:
        return None
    groups = {code: [c for c in encoded.columns if "_" + code in c] for code in question_codes(targets)}
    sums = []
    for g, cols in groups.items():
        row = sum((F.col(c).cast("double") for c in cols), F.lit(0.0))
        sums += [F.sum(F.col(c).cast("double")).alias(f"{g}|{i}") for i, c in enumerate(cols)]
        sums.append(F.sum(row * row).alias(f"{g}|sq"))
    per = encoded.groupBy(F.col(segment).cast("string").alias("cluster")).agg(*sums)
    names = [c for c in per.columns if c != "cluster"]
    whole = per.agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in names]).withColumn("cluster", F.lit("all_clusters"))
    both = per.unionByName(whole)
    scores = []
    for g, cols in groups.items():
        k = len(cols)
        parts = [F.col(f"`{g}|{i}`") for i in range(k)]
        total = sum(parts, F.lit(0.0))
        squares = sum((c * c for c in parts), F.lit(0.0))
        q = F.try_divide((k - 1) * (k * squares - total * total), k * total - F.col(f"`{g}|sq`"))
        share = F.round(F.try_divide(q - (k - 1), q) * 100, 3)
        scores.append(F.when(share > 0, share))
    return (both.select("cluster", F.explode(F.array(*scores)).alias("share"))
            .groupBy("cluster").agg(F.round(F.avg("share"), 3).alias("variability")))


def magnitude(deliver: DataFrame, sizes: DataFrame, n_targets: int) -> DataFrame | None:
    """Segment share times its share of significant targetables, and their sum.

    Matched by segment; a segment without findings counts as 0. No rows when the sum is not in (0, 1].
    """
    if n_targets == 0:
        return None
    found = (deliver.filter(F.lower("q_code").contains("tgt")).groupBy(F.col("targeting_seg").alias("cluster"))
             .agg(F.count(F.lit(1)).alias("n_sig")))
    share = F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 2)
    per = (sizes.select("cluster", share.alias("share")).join(found, "cluster", "left")
           .select("cluster", F.round(F.col("share") * F.coalesce("n_sig", F.lit(0)) / n_targets, 3).alias("magnitude")))
    whole = per.agg(F.round(F.sum("magnitude"), 3).alias("magnitude"))
    both = per.unionByName(whole.select(F.lit("all_clusters").alias("cluster"), "magnitude"))
    total = F.max(F.when(F.col("cluster") == "all_clusters", F.col("magnitude"))).over(Window.partitionBy())
    return both.withColumn("total", total).filter("total > 0 AND total <= 1").drop("total")


# --- signal of a learned model ------------------------------------------------------------------------


def ml_signal(encoded: DataFrame, segment: str = "cluster", id_col: str = "id", seed: int = 42,
              trees: int = TREES, depth: int = 10) -> DataFrame | None:
    """How well a random forest tells the segments from the targetable columns.

    Row ``all`` is scored on a third held out by key; each segment is scored on all of its rows.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    targets = [c for c in encoded.columns if "tgt" in c.lower()]
    if not targets:
        return None
    rows = encoded.select(F.col(id_col), F.col(segment).cast("string").alias("cluster"),
                          *[F.col(c).cast("double").alias(c) for c in targets])
    rows = VectorAssembler(inputCols=targets, outputCol="features").transform(rows)
    names = StringIndexer(inputCol="cluster", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    rows = names.transform(rows).withColumn("held_out", unit_hash(id_col, seed) < HOLD_OUT)
    rows = rows.select("cluster", "label", "features", "held_out").persist()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(rows.filter(~F.col("held_out")))
    confusion = (forest.transform(rows).groupBy("held_out", "cluster", "label", "prediction").count()).collect()
    rows.unpersist()
    cells = [(r["held_out"], r["cluster"], int(r["label"]), int(r["prediction"]), r["count"]) for r in confusion]
    scored = [("all", *_weighted_scores([(t, p, n) for held, _, t, p, n in cells if held]))]
    for s in sorted({c[1] for c in cells}):
        scored.append((s, *_weighted_scores([(t, p, n) for _, name, t, p, n in cells if name == s])))
    return encoded.sparkSession.createDataFrame(
        scored, "cluster string, signal double, f1_score double, precision double, recall_score double")


def _weighted_scores(cells: list[tuple[int, int, int]]) -> tuple[float, float, float, float]:
    """Accuracy, F1, precision and recall weighted by true class size, from confusion cells."""
    total = sum(n for *_, n in cells)
    if not total:
        return 0.0, 0.0, 0.0, 0.0
    f1 = precision = recall = hits = 0.0
    for label in {t for t, _, _ in cells}:
        tp = sum(n for t, p, n in cells if t == label == p)
        real = sum(n for t, _, n in cells if t == label)
        told = sum(n for _, p, n in cells if p == label)
        p_, r_ = (tp / told if told else 0.0), tp / real
        hits += tp
        precision += p_ * real / total
        recall += r_ * real / total
        f1 += (2 * p_ * r_ / (p_ + r_) if p_ + r_ else 0.0) * real / total
    return tuple(round(v, 3) for v in (hits / total, f1, precision, recall))
