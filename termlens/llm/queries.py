"""Registered queries of the corpus operators: opN_<name>(spark, sf_dir), each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocation, decontam, embeddings, html, lexical, lm, rankbpe, secrets, simhash, substring, tokenfiles, toxicity
from .common import id_remainder, read, scratch
from .sql import SQL  # noqa: F401


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text")


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every word in a 13-word window that a document with a smaller id also holds."""
    t = substring.dedup(_docs(spark, sf_dir), window=13)
    return t.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by a model of the labelled rows whose crc32(doc_id) mod 5 is not 0."""
    docs = _docs(spark, sf_dir)
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(id_remainder("doc_id", 5) != 0))
    return toxicity.scores(docs, model).select(
        "doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text with forced-boundary BPE, decode it again; digests of both."""
    t = bpe.decode(bpe.encode(_docs(spark, sf_dir)).drop("text"))
    return t.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, share) for every benchmark item that a document contains; clean documents have no row."""
    return decontam.search(_docs(spark, sf_dir), read(spark, sf_dir, "benchmark"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: the rules' spans and those that the trained network adds."""
    docs = _docs(spark, sf_dir)
    t = secrets.scan(docs, secrets.fit(docs))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return t.select("doc_id", count("assign"), count("access"), count("hex"),
                    F.sha2(line(F.filter("spans", lambda s: s["kind"] != "net")), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash over 3-word shingles, links at 2 or fewer differing bits, components."""
    t = simhash.near_duplicates(_docs(spark, sf_dir), shingle=3, max_bits=2)
    return t.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every text by a model of those whose crc32(doc_id) mod 7 is not 2."""
    docs = _docs(spark, sf_dir).withColumn("learn", id_remainder("doc_id", 7) != 2)
    return lm.scores(docs).withColumn("held_out", id_remainder("doc_id", 7) == 2)


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at cosine >= 0.95, and their components."""
    t = embeddings.near_duplicates(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.95)
    return t.withColumnRenamed("id", "vec_id")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article text of every page."""
    t = html.extract(read(spark, sf_dir, "pages"))
    return t.withColumn("n_chars", F.length("text").cast("bigint"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids (id 0 at its end) as Parquet token files and index what the files hold."""
    out = scratch(spark, "tokens") + "/t"
    tokenfiles.write_tokens(_docs(spark, sf_dir), out, end_id=0)
    return tokenfiles.index(spark, out)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text with the rank file (perfect hash, then heap merges), decode it again; digests of both."""
    t = rankbpe.decode(rankbpe.encode(_docs(spark, sf_dir), packed=True).drop("text"))
    return t.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for every benchmark item."""
    return lexical.search(lexical.build(_docs(spark, sf_dir)), read(spark, sf_dir, "benchmark"), k=10)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases of two to five words that occur a hundred times or more."""
    return collocation.collocations(read(spark, sf_dir, "documents"), min_count=100, top=2000)


QUERIES = {f.__name__: f for f in (op1_substring, op2_toxicity, op3_bpe, op4_decontamination, op5_secrets, op6_simhash, op7_lm, op8_embeddings, op9_html,
                                   op10_tokens, op11_bpe, op12_search, op13_collocations)}
