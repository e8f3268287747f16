"""Language ID by Bayesian fusion of what the text, the markup and the address say.

Text: hashed byte trigrams under a multinomial model per language, fitted on at most
``per_language`` labelled documents of each language, chosen by hash of their id.  Markup: how
often the declared language of a page goes with each language.  Address: how often the
languages occur under the page's suffix, domain and host, each level smoothed with the one
above it and, at the top, with all pages.  Declarations and addresses are counted over
all pages by grouped aggregation, with the text's probabilities as fractional counts in
whole millionths, so that sums do not depend on their order; a page's own share is taken out
before its prior is formed.

Defined cases: null or empty html has no text evidence.  An url that is null or has no
``://`` belongs to the empty host.  A page that declares nothing, or a language that no
labelled document has, still is evidence, under a name of its own.  Ties go to the first
language in code point order.  Without labelled documents language and probability are null.
Repeated rows count and are returned each; extra columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, query, read, uniform, utf8, written
from tidemark.llm.url_rules import url_host

GRAM_BITS = 16
SLAB = 1 << 20
SMOOTHING = 0.5
# Neighbouring trigrams say much the same: n of them count as n / (1 + n / ENOUGH).
ENOUGH = 100.0
KAPPA = 5.0  # pages that the level above is worth
UNIT = 1_000_000
TAGS = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.I | re.S)


def grams(text: bytes) -> np.ndarray:
    """How often each hashed trigram occurs."""
    counts = np.zeros(1 << GRAM_BITS, dtype=np.int64)
    for start in range(0, len(text), SLAB):
        b = np.frombuffer(text[start : start + SLAB + 2], dtype=np.uint8).astype(np.uint32)
        if len(b) >= 3:
            code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
            counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS), minlength=len(counts))
    return counts


def page_text(html: bytes) -> bytes:
    return b" ".join(TAGS.sub(b" ", html).lower().split())


def train(docs: DataFrame, per_language: int = 400) -> tuple[list[str], np.ndarray]:
    """The languages and, per language, the log probability of each trigram."""
    chosen = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")))
    labelled = docs.select("doc_id", "lang", "text").where("lang IS NOT NULL AND lang <> '' AND doc_id IS NOT NULL")
    # The ids first, so that only chosen texts are counted: per_language rows of each language,
    # those with the smallest hashes.  Tasks drop what is not likely to be among them.
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("size"))
    likely = uniform(F.xxhash64("doc_id")) < (2 * per_language + 100) / F.col("size")
    # A row per language, of which the model holds 2^GRAM_BITS numbers each.
    ids = labelled.select("doc_id", "lang").join(F.broadcast(sizes), "lang").where(likely).withColumn(
        "nth", F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ).where(F.col("nth") <= per_language).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    texts = labelled.join(
        F.broadcast(ids), (labelled["doc_id"] == ids["_id"]) & (labelled["lang"] == ids["_lang"])
    ).select("doc_id", "lang", "text").withColumn("nth", chosen).where(F.col("nth") <= per_language)

    def counted(languages, texts):
        sums: dict[str, np.ndarray] = {}
        for language, text in zip(languages.to_pylist(), utf8(texts)):
            found = grams(b" ".join(text.lower().split()))
            sums[language] = sums.get(language, 0) + found
        for language, counts in sums.items():
            used = np.flatnonzero(counts)
            yield [[language] * len(used), used, counts[used]]

    rows = (
        map_columns(texts, counted, "lang string, gram long, n long", F.col("lang"), F.col("text"))
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list("gram").alias("grams"), F.collect_list("n").alias("counts"))
        .collect()
    )
    languages = sorted(row["lang"] for row in rows)
    counts = np.full((len(languages), 1 << GRAM_BITS), SMOOTHING)
    for row in rows:
        counts[languages.index(row["lang"]), row["grams"]] += row["counts"]
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def softmax(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max())
    return p / p.sum()


def text_evidence(model: np.ndarray, html: bytes) -> np.ndarray:
    """Log likelihood per language, damped."""
    counts = grams(page_text(html))
    n = counts.sum()
    if not n:
        return np.zeros(len(model))
    used = np.flatnonzero(counts)
    return (model[:, used] @ counts[used].astype(np.float64)) / n * (n / (1 + n / ENOUGH))


def declared(html: Column, languages: list[str]) -> Column:
    """The main part of the declared language; ``other`` if it is none of ``languages``."""
    name = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1))
    return F.when(name.isin(*languages), name).when(name == "", F.lit("none")).otherwise(F.coalesce(
        F.when(name.isNotNull(), F.lit("other")), F.lit("none")
    ))


def suffix_of(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def priors(own: np.ndarray, levels: list[np.ndarray], everything: np.ndarray) -> np.ndarray:
    """Smoothed shares from all pages down to the host, the page itself left out."""
    rest = np.maximum(everything - own, 0) + 1.0 / len(own)
    share = rest / rest.sum()
    for counts in levels:
        left = np.maximum(counts - own, 0)
        share = (left + KAPPA * share) / (left.sum() + KAPPA)
    return share


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, host, declared, language and probability per row of ``pages``."""
    spark = pages.sparkSession
    languages, model = train(docs)
    host = url_host(F.col("url"))
    if not languages:
        return pages.select(
            F.col("page_id").cast("long").alias("page_id"), host.alias("host"),
            declared(F.col("html"), [""]).alias("declared"),
            F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"),
        )
    shared = spark.sparkContext.broadcast(model)

    def heard(ids, hosts, names, htmls):
        scores = [text_evidence(shared.value, html) for html in utf8(htmls)]
        own = [np.rint(softmax(s) * UNIT).astype(np.int64) for s in scores]
        yield [ids, hosts, names, [s.tolist() for s in scores], [o.tolist() for o in own]]

    evidence = written(
        map_columns(
            pages, heard, "page_id long, host string, declared string, scores array<double>, own array<long>",
            F.col("page_id").cast("long"), host, declared(F.col("html"), languages), F.col("html"),
        ).withColumns({"domain": suffix_of(F.col("host"), 2), "suffix": suffix_of(F.col("host"), 1)})
    )
    total = F.array(*(F.sum(F.col("own")[i]) for i in range(len(languages))))
    by_name = {r["declared"]: r["t"] for r in evidence.groupBy("declared").agg(total.alias("t")).collect()}
    names = [*languages, "other", "none"]
    counts = np.array([by_name.get(name, [0] * len(languages)) for name in names], dtype=np.float64).T / UNIT
    # A page is assumed to declare its language, by as much as KAPPA pages say.
    counts[:, : len(languages)] += KAPPA * np.eye(len(languages))
    counts += 0.1
    says = np.log(counts / counts.sum(axis=1, keepdims=True))
    everything = np.array(list(by_name.values()), dtype=np.float64).reshape(-1, len(languages)).sum(axis=0) / UNIT

    hosts = evidence.groupBy("host", "domain", "suffix").agg(total.alias("by_host"))
    domains = hosts.groupBy("domain").agg(
        F.array(*(F.sum(F.col("by_host")[i]) for i in range(len(languages)))).alias("by_domain")
    )
    suffixes = hosts.groupBy("suffix").agg(
        F.array(*(F.sum(F.col("by_host")[i]) for i in range(len(languages)))).alias("by_suffix")
    )
    # Written, so that the joins can split the partition of a domain or suffix with many hosts.
    domains, suffixes = written(domains), written(suffixes)
    places = written(hosts.join(domains, "domain").join(suffixes, "suffix").drop("domain", "suffix"))

    def fused(ids, hosts, declareds, scores, own, by_suffix, by_domain, by_host):
        width = len(languages)
        flat = lambda c: c.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        own, levels = flat(own) / UNIT, [flat(c) / UNIT for c in (by_suffix, by_domain, by_host)]
        said = np.array([names.index(d) for d in declareds.to_pylist()], dtype=int)
        posts = [
            softmax(s + says[:, d] + np.log(priors(o, [level[i] for level in levels], everything)))
            for i, (s, d, o) in enumerate(zip(flat(scores), said, own))
        ]
        best = [int(np.argmax(p)) for p in posts]
        yield [
            ids, hosts, declareds, pa.array([languages[b] for b in best]),
            pa.array([float(p[b]) for p, b in zip(posts, best)]),
        ]

    joined = evidence.drop("domain", "suffix").join(places, "host")
    return map_columns(
        joined, fused, "page_id long, host string, declared string, language string, probability double",
        *(F.col(c) for c in ("page_id", "host", "declared", "scores", "own", "by_suffix", "by_domain", "by_host")),
    )


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))
