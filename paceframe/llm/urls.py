"""URL filters: rules by host suffix and path prefix, and a model of host and path text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import ascii_lower

DIM = 1 << 14
NGRAMS = (3, 4, 5)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    block: bool

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", True),
    Rule("example.net", "/en/", False),
    Rule("example.com", "/de/", True),
    Rule("org", "/fr/", False),
)

# labelled URLs the model is trained on: words of junk topics and of ordinary sites. Companions, joints,
# domains and paths are dealt alike to both, so that only the words tell them apart.
JUNK_WORDS = tuple(
    """casino poker betting bets slots jackpot roulette gambling lottery bingo viagra pills pharmacy meds cialis steroids
    loans payday lender porn xxx adult escorts webcams hookup nude replica followers spam spammer clickbait popup
    adserver banners ads tracker tracking pixel malware warez cracked keygen bitcoin doubler giveaway""".split()
)
GOOD_WORDS = tuple(
    """research library garden kitchen newspaper history weather cooking college science travel museum theatre music
    school hospital bakery carpenter bicycle railway harbour village mountain river forest animals birds
    physics chemistry geography language dictionary grammar literature poetry painting sculpture architecture engineering
    software compiler database network hardware camera cinema concert festival football tennis swimming
    sailing cycling hiking camping recipes vegetables orchard farming tractor insurance banking ministry parliament
    embassy council court justice police firefighters ambulance nursing dentist veterinary children kindergarten
    teachers students lectures journal magazine publisher bookstore archive gallery furniture plumbing electrician
    heating windows bridges tunnels airport ferry station astronomy geology climate ocean island
    weaving pottery knitting watchmaker philosophy""".split()
)
COMPANIONS = ("my", "best", "city", "online", "world", "the", "central", "home", "club", "network", "first")
PLACES = (("", "com"), ("www.", "org"), ("m.", "net"), ("blog.", "info"), ("", "co.uk"), ("news.", "de"), ("shop.", "io"))
PATHS = ("", "/", "/index.html", "/en/17", "/a/b.php?id=4", "/2024/05/12/", "/fr/204.html", "/about", "/p/31/", "/de/9?page=2", "/es/8", "/list", "/x")


def _labelled(words: Sequence[str], each: int = 9) -> tuple[str, ...]:
    """``each`` URLs per word: alone, joined and with hyphens, before and after a companion, and on a host of others."""
    out = []
    for i, word in enumerate(words):
        for k in range(each):
            n = i * each + k
            other = COMPANIONS[n % len(COMPANIONS)]
            name = (word, f"{word}-{other}", f"{word}{other}", f"{other}-{word}", f"{other}{word}", f"{word}-{n % 90}",
                    f"{other}-{word}.{COMPANIONS[(n + 3) % len(COMPANIONS)]}", f"{word}.{other}", f"{other}{word}-{COMPANIONS[(n + 5) % len(COMPANIONS)]}.{other}")[k % 9]
            sub, top = PLACES[n % len(PLACES)]
            out.append(f"{('http', 'https')[n % 2]}://{sub}{name}.{top}{PATHS[n % len(PATHS)]}")
    return tuple(out)


JUNK_URLS = _labelled(JUNK_WORDS)
GOOD_URLS = _labelled(GOOD_WORDS)


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty if there is none."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as a struct (text, block); NULL if none fits. Equal lengths: blocking first."""
    if not rules:
        return F.lit(None).cast("struct<text:string,block:boolean>")
    ordered = sorted(rules, key=lambda r: (-len(r.text), not r.block, r.text))
    known = F.array(*[
        F.struct(F.lit(r.host).alias("host"), F.lit(r.path).alias("path"), F.lit(r.text).alias("text"), F.lit(r.block).alias("block"))
        for r in ordered
    ])
    fits = F.filter(
        known,
        lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]),
    )
    first = F.get(fits, F.lit(0))
    return F.struct(first["text"].alias("text"), first["block"].alias("block"))


def ngrams(host: Column, path: Column) -> Column:
    """Character n-grams of ``host`` and ``path``, each marked with its part and framed by ``^`` and ``$``."""
    def of(part: Column, tag: str, n: int) -> Column:
        framed = F.concat(F.lit("^"), part, F.lit("$"))
        starts = F.when(F.length(framed) >= n, F.sequence(F.lit(1), F.length(framed) - F.lit(n - 1)))
        grams = F.transform(starts, lambda i: F.concat(F.lit(tag), F.substring(framed, i, F.lit(n))))
        return F.coalesce(grams, F.array().cast("array<string>"))

    return F.concat(*[of(p, t, n) for p, t in ((host, "h"), (path, "p")) for n in NGRAMS])


def _featured(df: DataFrame) -> DataFrame:
    return HashingTF(inputCol="_grams", outputCol="_features", numFeatures=DIM, binary=True).transform(
        df.withColumn("_grams", ngrams(F.col("_host"), F.col("_path")))
    )


def fit(spark: SparkSession, good: Sequence[str] = GOOD_URLS, junk: Sequence[str] = JUNK_URLS) -> LogisticRegressionModel:
    """Logistic regression over hashed n-grams of a small labelled URL table; both classes weigh the same."""
    def labelled(known: Sequence[str], label: float) -> DataFrame:
        # one text that is cut, as a literal per URL makes the plan slow
        url = F.explode(F.split(F.lit("\n".join(known)), "\n")).alias("url")
        weight = (len(good) + len(junk)) / (2.0 * max(len(known), 1))
        return spark.range(1).select(url, F.lit(label).alias("label"), F.lit(weight).alias("weight"))

    table = labelled(good, 0.0).unionByName(labelled(junk, 1.0))
    rows = _featured(table.select("label", "weight", host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path")))
    return LogisticRegression(
        featuresCol="_features", labelCol="label", weightCol="weight", maxIter=60, regParam=0.003, standardization=False
    ).fit(rows.coalesce(1))


def judge(
    pages: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES, model: LogisticRegressionModel | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``junk_score`` and ``verdict`` to every row.

    A rule decides where one fits, else the model: ``block`` from ``threshold``
    upwards. A NULL url or one without ``://`` has empty host and path, fits no
    rule and is allowed. Repeated rows are judged alike, an empty table stays
    empty, and input columns with the names of added ones are replaced.
    """
    model = model or fit(pages.sparkSession)
    added = ("host", "path", "rule", "junk_score", "verdict")
    keep = [c for c in pages.columns if c not in added and not c.startswith("_url_")]
    rows = pages.select(
        *[F.col(f"`{c}`") for c in keep], host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path")
    )
    scored = model.transform(_featured(rows))
    junk = F.when(F.concat("_host", "_path") == "", F.lit(0.0)).otherwise(vector_to_array("probability")[1])
    rule = best_rule(F.col("_host"), F.col("_path"), rules)
    return scored.select(
        *[F.col(f"`{c}`") for c in keep], F.col("_host").alias("host"), F.col("_path").alias("path"),
        rule.alias("_rule"), junk.alias("junk_score"),
    ).select(
        *[F.col(f"`{c}`") for c in keep], "host", "path", F.col("_rule.text").alias("rule"), "junk_score",
        F.when(F.coalesce(F.col("_rule.block"), F.col("junk_score") >= threshold), "block").otherwise("allow").alias("verdict"),
    )
