"""URL filter: rules, then logistic regression on hashed character n-grams.

Only DataFrame expressions: the host's and the path's characters become runs of three
to five, each run is hashed into one of DIM buckets, and the score is the sum of the
buckets' weights, host and path apart, each over the root of its number of buckets. The
weights come from Spark ML's logistic regression over a small labelled URL table (its
bound is MAX_LABELS) and go into the plan as one constant. The table's names are made by
rule from general words, without a look at the URLs to be judged.
"""

from __future__ import annotations

import math
import string

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, Normalizer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIM = 4096
SIZES = [3, 4, 5]
MAX_LABELS = 20_000
PENALTY = 0.00002
COST = 2.0                # a page wrongly blocked weighs as much as two wrongly allowed

# Rules of the filter, as (rule, verdict)
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]

# General words that the names of the labelled URL table are made of
BLOCKED = """
casino poker roulette blackjack slots jackpot betting bet wager gambling bingo lottery sportsbook bookmaker
pharmacy pharma viagra cialis xanax tramadol pills meds drugs steroids prescription
porn xxx sex adult escort erotic nude webcam hookup milf fetish
malware trojan virus keylogger exploit botnet ransomware spyware hack
phishing verify-account secure-login account-update password-reset bank-alert login-confirm suspended
crack keygen warez serial torrent nulled pirated
payday loan cash-advance get-rich easy-money giveaway prize winner free-gift reward sweepstake
replica counterfeit fake spam clickbait cheap ads popup adserver tracker banner affiliate backlink linkfarm
""".split()
ALLOWED = """
news library museum university school college academy history science physics chemistry biology mathematics
music theatre cinema film radio gallery opera dance painting poetry novel book magazine journal gazette press
weather climate ocean river mountain forest garden farm orchard harbour island valley village town city county council
parliament government ministry embassy court law police fire hospital health clinic medicine doctor nurse dentist
recipe cooking kitchen bakery coffee tea restaurant hotel travel train railway bus bicycle airport ferry
software code developer docs wiki forum support research data maps engineering robotics electronics camera
football cricket tennis chess rowing sailing running climbing hiking fishing
family children parents church temple charity heritage archive language dictionary grammar translation
insurance bank accounting business market furniture carpentry plumbing building architecture design fashion
""".split()
NEUTRAL = "online best my the shop site world home pro hub zone club top live 24 365 now plus web go daily free new info".split()
SYLLABLES = "ba ce di fo gu ha li mo nu pe ra si to va wen lor tan ber mil ston field ham ley wick ford den".split()
PREFIXES = ["", "www.", "m.", "blog."]
SUFFIXES = [".com", ".net", ".org", ".example.com", ".example.net", ".example.org", ".info", ".co.uk", ".example.edu"]
PATHS = ["/", "", "/en/{}", "/fr/{}.html", "/de/{}/", "/es/{}?page=2", "/articles/{}", "/a/b/{}", "/index.php?id={}"]


def names_of(words: list[str], shift: int, beside: list[str]) -> list[str]:
    """Each word alone, as a plural, and beside neutral ones and those of ``beside``, before and after,
    with a hyphen and with none."""
    out = []
    for i, w in enumerate(words):
        other = lambda k: NEUTRAL[(i * 7 + k * 5 + shift) % len(NEUTRAL)]
        joined = w.replace("-", "")
        out += [w, f"{joined}s", f"{w}-{other(0)}", f"{other(1)}-{w}", f"{joined}{other(2)}", f"{other(3)}{joined}",
                f"{w}-{beside[(i * 3 + 1) % len(beside)]}", f"{beside[i * 5 % len(beside)]}-{joined}",
                f"{other(4)}-{joined}s-{other(5)}", f"{other(6)}-{other(7)}-{w}"]
    return out


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``(url, label)``: 1 block, 0 allow. Prefixes, endings and paths come round in turn for
    both labels, so that only the words tell them apart; one blocked word makes a name bad, whatever
    stands beside it; more allowed names are invented
    ones, of two to five syllables."""
    pick = lambda i, a, b: SYLLABLES[(i * a + i // len(SYLLABLES) + b) % len(SYLLABLES)]
    made = [pick(i, 1, 0) + pick(i, 7, 3) + (pick(i, 11, 5) if i % 2 else "")
            + ("-" + pick(i, 5, 1) + pick(i, 3, 2) if i % 3 == 0 else "") for i in range(900)]
    rows = []
    for label, names in ((1, names_of(BLOCKED, 0, ALLOWED)), (0, names_of(ALLOWED, 3, ALLOWED)), (0, made)):
        for i, name in enumerate(names):
            host = PREFIXES[i % 4] + name + SUFFIXES[i // 4 % 9]
            rows.append((f"http{'s' * (i % 2)}://{host}{PATHS[i * 5 % 9].format(i // 9 % 7)}", label))
    return spark.createDataFrame(rows, "url string, label int")


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased) and path (then up to ``?``, ``#`` or the end); both empty without ``://``."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(url, pattern, 2)
    return df.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def matched_rule(rules: list[tuple[str, str]], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host is the url's or a parent domain of it
    and whose path begins the url's; null if none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, rest = text.partition("/")
        fits = ((F.col(host) == domain) | F.endswith(F.col(host), F.lit("." + domain))) \
            & F.startswith(F.col(path), F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def grams(text: Column, kind: str, sizes: list[int] = SIZES, dim: int = DIM) -> Column:
    """Buckets of the character runs of a text between end marks."""
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    n = F.char_length(text) + 2

    def runs(of: Column, k: int) -> Column:
        bucket = lambda i: F.pmod(F.xxhash64(F.lit(kind), *(F.get(of, i + j) for j in range(k))), F.lit(dim))
        return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: bucket(i).cast("int"))) \
            .otherwise(F.array().cast("array<int>"))

    # the outer transform names the array, so that it is made once and not for every run
    return F.transform(F.array(chars), lambda of: F.concat(*(runs(of, k) for k in sizes)))[0]


def train(labels: DataFrame, penalty: float = PENALTY, max_labels: int = MAX_LABELS) -> tuple[list[float], float]:
    """(weights, intercept) from ``labels(url, label)``. Rows without url or label are left
    out; more than ``max_labels`` are refused, not sampled."""
    labels = labels.where("url is not null and label is not null")
    n = labels.count()
    if n > max_labels:
        raise ValueError(f"{n} labelled URLs, more than {max_labels}")
    if labels.select("label").distinct().count() < 2:
        return [0.0] * (2 * DIM), -1.0                # nothing to learn from: allow
    buckets = [str(k) for k in range(DIM)]
    parts = with_parts(labels).select(F.col("label").cast("double").alias("label"), *(
        F.array_distinct(grams(F.col(c), c)).cast("array<string>").alias(c) for c in ("host", "path")))
    steps = []
    for c in ("host", "path"):                         # each bucket once, over the root of their number
        steps += [CountVectorizerModel.from_vocabulary(buckets, inputCol=c, outputCol=c + "_has", binary=True),
                  Normalizer(inputCol=c + "_has", outputCol=c + "_unit", p=2.0)]
    steps += [VectorAssembler(inputCols=["host_unit", "path_unit"], outputCol="features"),
              LogisticRegression(regParam=penalty, maxIter=50, standardization=False)]
    # the table is small by its bound: one task spares the rounds their overhead
    model = Pipeline(stages=steps).fit(parts.coalesce(1)).stages[-1]
    return [round(float(x), 6) for x in model.coefficients.toArray()], float(model.intercept)


def score(weights: list[float], intercept: float) -> Column:
    """Log odds of block from host and path, less those of COST."""
    def total(c: str, own: list[float]) -> Column:
        table = F.split(F.lit(",".join(map(repr, own))), ",").cast("array<double>")
        mean = lambda g: F.aggregate(g, F.lit(0.0), lambda s, k: s + F.get(table, k)) \
            / F.sqrt(F.greatest(F.size(g), F.lit(1)))
        return F.transform(F.array(F.array_distinct(grams(F.col(c), c))), mean)[0]

    return F.lit(intercept - math.log(COST)) + total("host", weights[:DIM]) + total("path", weights[DIM:])


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, labels: DataFrame | None = None,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for every row of ``pages``: the longest
    rule's verdict, else block if the regression's log odds are above 0.

    Null urls, and those without ``://``: host and path empty, which the regression alone
    judges. Repeated rows each give a row; other columns are ignored; no rows: empty."""
    weights, intercept = train(labels if labels is not None else labelled_urls(pages.sparkSession))
    rule, verdict = matched_rule(rules)
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("_url"))
    judged = with_parts(src, "_url").withColumn("score", score(weights, intercept))
    return judged.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")
