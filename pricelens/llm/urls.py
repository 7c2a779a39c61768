"""URL filters: host/path rules first, a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

import zlib

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, pick

#: Fixed values: (verdict, host, path) of the rules the registered query applies.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: Words that name what is unwanted on the web, and words of ordinary sites.
UNWANTED = ("casino poker betting jackpot slots lottery bonus gamble roulette wager viagra cialis pills pharmacy steroid diet detox keto miracle adult "
            "porn xxx sex cams escort nude dating hookup spam farm linkfarm backlinks clickbait traffic replica fake counterfeit knockoff cheap "
            "discount free payday loan credit debt crypto airdrop giveaway prize winner malware crack keygen warez torrent pirate phishing hack "
            "botnet exploit ransom scam ads adserver tracker banner popup bets win").split()
ORDINARY = ("library university school college museum archive history science physics biology chemistry medicine health hospital weather climate "
            "news journal daily times herald gazette review sports football cricket tennis travel hotel flights maps railway airport city "
            "council government parliament court police recipes kitchen garden cooking bakery coffee music concert theatre cinema film books "
            "poetry novel language grammar dictionary software docs support developer code forum community wiki blog photo gallery design "
            "fashion furniture cars bicycle repair market shop books bank insurance energy water forest river mountain island animals birds "
            "family children parents jobs career training course events calendar").split()
#: Parts that say nothing, on either side of the table.
FRONTS, ENDS = ("", "www.", "m.", "blog.", "news."), ("com", "net", "org", "example.com", "example.net", "info")
PATHS = ("/", "/en/{}", "/fr/{}", "/de/{}.html", "/es/{}/", "/page/{}?p=2", "/a/{}#top", "/index.html")
#: Letters as often as in running text, for made-up words.
LETTERS = "eeeeeeetttttaaaaaooooiiiinnnnssssshhhhrrrrddlllluucccmmwwffggyyppbbvk"


def labelled_urls(each: int = 8, made_up: int = 900) -> list[tuple[str, int]]:
    """The small labelled table the model is trained on, (url, 1 = unwanted), made by rule from the words above.

    Every word has ``each`` urls, whose hosts join it with another of its kind
    or a made-up word; ``made_up`` more ordinary hosts are made-up words alone, so that
    letters that were never seen together count as ordinary.  Fronts, ends and paths are dealt to
    both kinds alike, by a checksum.
    """
    def draw(options, *key):
        return options[zlib.crc32(repr(key).encode()) % len(options)]

    def invented(k: int) -> str:
        return "".join(draw(LETTERS, "letter", k, i) for i in range(4 + k % 7))

    def url(host: str, word: str, k: int) -> str:
        path = draw((*PATHS, "/{}-" + word, "/" + word + "/{}"), "path", host, k).format(zlib.crc32(host.encode()) % 991)
        return f"{draw(('http', 'https'), 'scheme', host)}://{draw(FRONTS, 'front', host)}{host}.{draw(ENDS, 'end', host)}{path}"

    out = []
    for words, label in ((UNWANTED, 1), (ORDINARY, 0)):
        for w in words:
            for k in range(each):
                other = invented(zlib.crc32(w.encode()) % 997 + k) if k % 4 == 3 else draw(words, "other", w, k)
                parts = [w, other] if k % 2 else [other, w]
                out.append((url(draw(("-", ""), "joint", w, k).join(parts), w, k), label))
    return out + [(url(w, w, k), 0) for k, w in enumerate(map(invented, range(made_up)))]


def host_and_path(url) -> tuple:
    """(host, path) columns: host between the first ``://`` and ``/ ? #``, A-Z lower-cased; both empty without one."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host, path, rules):
    """The longest rule (host + path) that fits, as a struct(rule, verdict); null if none.

    A rule fits its host and all subdomains, for paths that start with the
    rule's.  Of equally long rules ``block`` wins, then the later in the
    alphabet.  ``rules`` is a short list held in the plan.
    """
    found = F.array(*[
        F.when(((host == F.lit(h)) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
               F.struct(F.lit(len(h + p)).alias("size"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule")))
        for v, h, p in rules
    ]) if rules else F.array().cast("array<struct<size:int,verdict:string,rule:string>>")
    return F.array_max(found)


def char_ngrams(host, path):
    """Distinct 3- to 5-grams of host and path, marked by the part they come from.

    A look-ahead finds overlapping n-grams in one pass over the text.
    """
    grams = lambda c, mark: [F.transform(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))"), 1),
                                         lambda g: F.concat(F.lit(mark), g)) for n in (3, 4, 5)]
    return F.array_distinct(F.concat(*grams(F.concat(F.lit("^"), host, F.lit("$")), "h"), *grams(path, "p")))


def _grams_of(df: DataFrame, url: str) -> DataFrame:
    host, path = host_and_path(F.col(url))
    return df.withColumn("host", host).withColumn("path", path).withColumn("grams", char_ngrams(F.col("host"), F.col("path")))


def train_url_model(labelled: DataFrame, features: int = 1 << 16, ridge: float = 1e-4) -> PipelineModel:
    """Fit the regression on a labelled table (url, label 0/1); rows with a null are left out.

    Both labels weigh the same in all, so 0.5 lies between them whatever their
    numbers.  The model is one vector of ``features`` weights, whatever the table's size.
    """
    rows = _grams_of(pick(labelled, "url", "label").dropna().withColumn("label", F.col("label").cast("double")), "url")
    n, unwanted = rows.agg(F.count("*"), F.sum("label")).first()
    share = F.when(F.col("label") == 1.0, F.lit(unwanted)).otherwise(F.lit(n - (unwanted or 0.0)))
    rows = rows.withColumn("weight", F.lit(n / 2.0) / share)
    return Pipeline(stages=[
        HashingTF(numFeatures=features, binary=True, inputCol="grams", outputCol="counts"),
        Normalizer(p=2.0, inputCol="counts", outputCol="features"),
        LogisticRegression(regParam=ridge, maxIter=200, standardization=False, weightCol="weight", probabilityCol="probability"),
    ]).fit(rows)


def judge_urls(pages: DataFrame, model: PipelineModel, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's chance that the url is unwanted) for every row.

    A null url or one without ``://`` has an empty host and path and is judged
    by the model's intercept alone.  Repeated rows are judged each; null ids
    stay null.  No shuffle: every row is judged where it is read.
    """
    rows = _grams_of(pick(pages, "page_id", "url"), "url")
    scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    best = matching_rule(F.col("host"), F.col("path"), rules)
    return scored.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"),
        "score")


def default_model(spark: SparkSession) -> PipelineModel:
    return train_url_model(spark.createDataFrame(labelled_urls(), "url string, label int"))
