"""One query per operator, over the whole of its table, and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.llm import (
    bpe, embedding_dedup, exact_dedup, licenses, line_dedup, merkle, mixing, onebit, pii, secrets, simhash, toxicity, trie,
)
from reviewflow.llm.common import load, prepare
from reviewflow.llm.oracle import ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if name in ORACLE:
            ORACLE_SQL[name] = ORACLE[name]
        return fn
    return deco


def tokenizer_files() -> tuple[str, str]:
    """Vocabulary file and pattern of the production tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@register("op1_line_dedup")
def op1(spark, sf_dir):
    """Every document with the lines of windows seen before taken out."""
    return line_dedup.dedup_lines(load(spark, sf_dir, "documents"), carry=False).select("doc_id", "n_lines", "n_removed", "text")


@register("op2_secret_scan")
def op2(spark, sf_dir):
    """Secrets in every document: counts, digest of the base spans, all spans."""
    found = secrets.scan(load(spark, sf_dir, "documents"))
    return found.select("doc_id", *[secrets.counted("all", k).alias(f"n_{kind}") for k, kind in enumerate(secrets.kinds())],
                        F.sha2(secrets.joined("base"), 256).alias("base_sha256"), secrets.joined("all").alias("spans"))


@register("op3_source_mixing")
def op3(spark, sf_dir):
    """How many words of every document the mix takes."""
    return mixing.mix(load(spark, sf_dir, "documents"), carry=False).select(
        "doc_id", "size", "source_size", "target", "taken")


@register("op4_exact_dedup")
def op4(spark, sf_dir):
    """Every document with the row that stays of its equal texts."""
    return exact_dedup.dedup_documents(load(spark, sf_dir, "documents"), int(spark.conf.get("spark.sql.shuffle.partitions"))).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op5_toxicity")
def op5(spark, sf_dir):
    """Every document's probabilities along the chain, and whether it is rejected."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))
    return scored.select("doc.doc_id", "scores.*")


@register("op6_license_scan")
def op6(spark, sf_dir):
    """Every document's best license, all that its windows and tags name, and the tags."""
    return licenses.scan(load(spark, sf_dir, "documents")).drop("places")


@register("op7_byte_bpe")
def op7(spark, sf_dir):
    """Digests of every document's token ids and of the bytes they decode to."""
    coder = bpe.Coder(spark, *tokenizer_files())
    coded = coder.decode(coder.encode(load(spark, sf_dir, "documents").select("doc_id", "text")))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op8_pii")
def op8(spark, sf_dir):
    """Personal data in every document: counts, digest of the base spans, all spans."""
    found = pii.scan(load(spark, sf_dir, "documents"))

    def count(k):
        return F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["k"] < pii.CRF_SPANS)
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
                        F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


@register("op9_simhash")
def op9(spark, sf_dir):
    """Every document with its fingerprint and near-duplicate component."""
    return simhash.near_duplicates(load(spark, sf_dir, "documents"), carry=False).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op10_embedding_dedup")
def op10(spark, sf_dir):
    """Every vector with its number of links and its component."""
    return embedding_dedup.near_duplicates(load(spark, sf_dir, "embeddings"))


@register("op11_conversation_trie")
def op11(spark, sf_dir):
    """The prefix trie of the rebuilt conversations, one row per node."""
    return trie.trie(trie.rebuilt(load(spark, sf_dir, "conversations"))).drop("turn_chars")


@register("op12_rotated_codes")
def op12(spark, sf_dir):
    """The 20 nearest rows of every row whose id is divisible by 20."""
    return onebit.search(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20).select("query_id", "rank", "vec_id", "score")


@register("op13_merkle_manifest")
def op13(spark, sf_dir):
    """Every document's leaf, subroot, root and proof, and what a leaf tampered with folds to."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.leaf_digest(n_chars=F.col("n_chars") + 1))
    made = merkle.manifest(load(spark, sf_dir, "documents"), tampered=tampered)
    checked = merkle.verify(merkle.proofs(made), "coalesce(tampered, leaf)")
    return checked.selectExpr("doc_id", "leaf", "subroot", "root", "sha2(array_join(path.digest, ''), 256) AS proof_sha256", "folded_root", "verified")
