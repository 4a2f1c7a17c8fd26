"""URL filter: rules first, then a ratio of character language models.

Rules decide the urls they fit; the longest fitting rule wins. The others are judged by two
smoothed Markov models over characters, one of urls that rules allow and one of urls that they
block. The context of a character varies in order: estimates of ever shorter contexts are mixed
by Witten-Bell weights, so a context counts by how much was seen of it. The difference of the
log-likelihoods, divided by the number of characters, is compared with a threshold that is
calibrated on rule-decided urls the models did not learn from.

Everything is DataFrame functions: urls are collapsed to distinct texts, cut into windows of
ORDER + 1 characters, and windows are joined to their scores.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule, and
its (empty) text scores 0. Without rule-decided urls of both kinds the threshold is 0. Repeated
rows get the same answer each; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourboard.llm.shared import join_unique, read, shuffled, stored

# The rules as given.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Characters of context.
ORDER = 4
#: Stands before the first character.
START = "\u0002"
#: Characters that a model without any knowledge expects, all alike.
ALPHABET = 256
#: One rule-decided url in so many is kept from the models and calibrates the threshold.
FOLDS = 4
#: Steps to one unit of the score when the threshold is sought; scores lie within +-LIMIT.
STEPS, LIMIT = 200, 20
#: Copies of each window's score, so that windows that nearly every url has are spread.
SALTS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits; null if none does."""
    found = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda rule: len(rule[0])):
        rule_host, _, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(f"/{rule_path}")
        found = F.when(fits, F.lit(text)).otherwise(found)
    return found


def windows(texts: DataFrame) -> DataFrame:
    """Each character of ``text`` with the ORDER characters before it: ``gram``."""
    padded = F.concat(F.lit(START * ORDER), F.col("text"))
    places = F.sequence(F.lit(1), F.length("text"))
    return (
        texts.where(F.length("text") > 0)
        .withColumn("padded", padded)
        .withColumn("at", F.explode(places))
        .withColumn("gram", F.expr(f"substring(padded, at, {ORDER + 1})"))
        .drop("padded", "at")
    )


def log_ratios(seen: DataFrame, grams: DataFrame) -> DataFrame:
    """``(gram, ratio)`` for distinct ``grams``, from the counts ``yes`` and ``no`` of the grams ``seen``."""
    scored = grams.select("gram", F.lit(1.0 / ALPHABET).alias("p_yes"), F.lit(1.0 / ALPHABET).alias("p_no"))
    for order in range(ORDER + 1):
        size = order + 1
        counts = seen.groupBy(F.right("gram", F.lit(size)).alias("tail")).agg(
            F.sum("yes").alias("yes"), F.sum("no").alias("no")
        )
        counts = counts.withColumn("context", F.expr(f"left(tail, {order})"))
        contexts = counts.groupBy("context").agg(
            F.sum("yes").alias("all_yes"),
            F.sum("no").alias("all_no"),
            F.count_if(F.col("yes") > 0).alias("kinds_yes"),
            F.count_if(F.col("no") > 0).alias("kinds_no"),
        )
        # One character has at most as many values as there are characters, and no character one.
        scored = (
            scored.withColumn("tail", F.right("gram", F.lit(size)))
            .withColumn("context", F.expr(f"left(tail, {order})"))
            .join((F.broadcast if size <= 1 else shuffled)(counts.drop("context")), "tail", "left")
            .join((F.broadcast if order <= 1 else shuffled)(contexts), "context", "left")
        )

        def mixed(kind: str) -> Column:
            kinds, total = F.coalesce(f"kinds_{kind}", F.lit(0)), F.coalesce(f"all_{kind}", F.lit(0))
            mix = (F.coalesce(kind, F.lit(0)) + kinds * F.col(f"p_{kind}")) / (total + kinds)
            return F.when(kinds > 0, mix).otherwise(F.col(f"p_{kind}"))

        scored = scored.select("gram", mixed("yes").alias("p_yes"), mixed("no").alias("p_no"))
    return scored.select("gram", (F.ln("p_yes") - F.ln("p_no")).alias("ratio"))


def scores(texts: DataFrame, seen: DataFrame) -> DataFrame:
    """``texts`` (distinct ``text``) with ``score``: the log-likelihood difference per character."""
    cut = windows(texts.select("text"))
    ratios = log_ratios(seen, cut.select("gram").distinct())
    spread = ratios.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    summed = (
        cut.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
        .join(shuffled(spread), ["gram", "salt"])
        .groupBy("text")
        .agg(F.sum("ratio").alias("total"))
    )
    return texts.join(shuffled(summed), "text", "left").select(
        *texts.columns, F.coalesce(F.col("total") / F.length("text"), F.lit(0.0)).alias("score")
    )


def threshold(judged: DataFrame) -> float:
    """Where the mean of both kinds' hit rates is best on held-out urls (``weight``, ``kind``, ``score``)."""
    step = F.greatest(F.lit(-LIMIT * STEPS), F.least(F.lit(LIMIT * STEPS), F.floor(F.col("score") * STEPS)))
    bins = judged.groupBy(step.alias("step")).agg(
        F.sum(F.when(F.col("kind") == "allow", F.col("weight")).otherwise(0)).alias("yes"),
        F.sum(F.when(F.col("kind") == "block", F.col("weight")).otherwise(0)).alias("no"),
    )
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 * LIMIT * STEPS + 1 rows
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def share(kind: str) -> Column:
        """Of a kind's urls, those below; null if there are none of the kind."""
        return F.try_divide(F.coalesce(F.sum(kind).over(below), F.lit(0)), F.sum(kind).over(whole))

    hits = bins.select("step", (share("no") + 1 - share("yes")).alias("hits")).where("hits is not null")
    best = hits.agg(F.max_by("step", F.struct("hits", -F.abs("step")))).first()[0]
    return (best or 0) / STEPS


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``(id_col, host, path, rule, verdict, score)`` of every row; score is null where a rule decides."""
    host, path = host_and_path(F.col(url_col))
    verdicts = F.create_map(*[F.lit(x) for rule in rules for x in rule])
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumn(
        "rule", rule_of(F.col("host"), F.col("path"), rules)
    )
    rows = rows.withColumn("kind", verdicts[F.col("rule")]).withColumn("text", F.concat("host", "path"))
    texts = stored(rows.groupBy("text", "kind").agg(F.count("*").alias("weight")), "urls")
    held_out = F.col("kind").isNull() | (F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == 0)
    seen = (
        windows(texts.where(~held_out))
        .groupBy("gram")
        .agg(
            F.sum(F.when(F.col("kind") == "allow", F.col("weight")).otherwise(0)).alias("yes"),
            F.sum(F.when(F.col("kind") == "block", F.col("weight")).otherwise(0)).alias("no"),
        )
    )
    judged = stored(scores(texts.where(held_out), stored(seen, "grams")), "scores")
    cut = threshold(judged.where(F.col("kind").isNotNull()))
    answers = judged.where(F.col("kind").isNull()).select(
        "text", "weight", "score", F.when(F.col("score") >= cut, "allow").otherwise("block").alias("judged")
    )
    ruled = rows.where(F.col("kind").isNotNull()).withColumn("score", F.lit(None).cast("double"))
    undecided = rows.where(F.col("kind").isNull()).drop("kind")
    free = join_unique(undecided, answers, ["text"], "weight", pages.count(), grows=True)
    columns = [id_col, "host", "path", "rule"]
    return ruled.select(*columns, F.col("kind").alias("verdict"), "score").unionByName(
        free.select(*columns, F.col("judged").alias("verdict"), "score")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read(spark, sf_dir, "pages"))
