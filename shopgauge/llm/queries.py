"""The queries of this subpackage by name: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.llm import anchors, decontaminate, jaccard, language, lockstep, oracles, packing, pages, pii, quality, repair, rollup, suffixes, topk
from shopgauge.llm.common import held_out, ship, written
from shopgauge.sources.shared import work_folder
from shopgauge.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return f(ship(spark), folder)

    QUERIES[f.__name__] = run
    return run


@_query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    return packing.packed(packing.pieces(load(spark, folder, "documents"), VOCABULARY))


@_query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    documents = load(spark, folder, "documents")
    held = held_out("doc_id", 4, 2)
    model = language.learn(documents.where(F.col("doc_id").isNotNull() & ~held))
    found = language.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@_query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels of rows that are not held out."""
    documents = load(spark, folder, "documents")
    held = held_out("doc_id", 5, 0)
    model = quality.learn(documents.where(~held), load(spark, folder, "labels").where(~held))
    found = quality.score(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


@_query
def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return pages.extract(load(spark, folder, "pages").select("page_id", "url", "html"))


@_query
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in documents, up to a fifth of an item's words edited."""
    return decontaminate.matches(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@_query
def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best inner products for every hundredth vector."""
    vectors = load(spark, folder, "embeddings").select("vec_id", topk.whole(F.col("embedding")).alias("vector"))
    return topk.search(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def _rolled(spark: SparkSession, folder: str, documents: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Totals after three batches: all documents come in by the first version, those labelled toxic go, those of low quality are counted
    by the second one. Every batch is sent twice. A version is its name and the column of its counts."""
    documents = written(documents)
    labels = load(spark, folder, "labels").select("doc_id", "toxic", "quality")
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    low = labels.where("quality = 0").select("doc_id").distinct().join(toxic, "doc_id", "left_anti")

    def of(rows: DataFrame, version: tuple[str, str]) -> DataFrame:
        return rollup.counted(rows, version[0], F.col(version[1]))

    store = rollup.TokenRollup(spark, work_folder(spark))
    again = documents.join(low, "doc_id", "left_semi")
    batches = {
        "first": rollup.signed(of(documents, first), 1),
        "withdrawn": rollup.signed(of(documents.join(toxic, "doc_id", "left_semi"), first), -1),
        "counted anew": rollup.revised(of(again, first), of(again, second)),
    }
    for _ in range(2):
        for name, changes in batches.items():
            store.commit(name, changes)
        store.compact()
    return store.totals()


@_query
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token totals by source, language and tokenizer version: two vocabularies' ids of whole texts, kept through `_rolled`'s batches."""
    counts = rollup.encoded(load(spark, folder, "documents"), VOCABULARY, PIECES)
    return _rolled(spark, folder, counts, ("byte_bpe_50k", "byte_tokens"), ("piece_bpe_32k", "piece_tokens"))


@_query
def rollup_words(spark: SparkSession, folder: str) -> DataFrame:
    """The same batches with counts that SQL has too: words, and a quarter of the length."""
    text = F.col("text")
    quarters = F.ceil(F.coalesce(F.length(text), F.lit(0)) / 4)
    documents = load(spark, folder, "documents").select("doc_id", "source", "lang", rollup.word_count(text).alias("words"), quarters.alias("quarters"))
    return _rolled(spark, folder, documents, ("words-1", "words"), ("quarters-1", "quarters"))


ORACLES["rollup_words"] = r"""
WITH counted AS (
    SELECT doc_id, source, lang,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words,
        coalesce(CAST(ceil(length(text) / 4.0) AS BIGINT), 0) AS quarters,
        doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic,
        doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS low
    FROM documents
)
SELECT source, lang, CASE WHEN low THEN 'quarters-1' ELSE 'words-1' END AS version,
    count(*) AS n_docs, CAST(sum(CASE WHEN low THEN quarters ELSE words END) AS BIGINT) AS n_tokens
FROM counted WHERE NOT toxic GROUP BY ALL
"""


@_query
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the words of 50-word runs that an earlier document has."""
    documents = load(spark, folder, "documents").select("doc_id", "text")
    return anchors.digest(anchors.strip(documents, anchors.repeats(documents)))


@_query
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents linked by the Jaccard similarity of their 5-word shingles."""
    return jaccard.link(load(spark, folder, "documents").select("doc_id", "text"))


@_query
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the bytes of 50-byte strings that an earlier document has."""
    documents = load(spark, folder, "documents").select("doc_id", "text")
    return suffixes.digest(suffixes.strip(documents, suffixes.repeats(documents)))


@_query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of tokens between the common cuts of two tokenizers, and how the links in them compare over all documents."""
    aligned = lockstep.numbered(lockstep.align(load(spark, folder, "documents"), VOCABULARY, PIECES))
    return lockstep.scored(aligned)


@_query
def op12_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: the base rules' spans and those added by the learned classifier."""
    found = pii.find(load(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@_query
def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Repair of all conversations after damage: what was wrong, what the repair costs, and its result."""
    return repair.audits(repair.repair(repair.damaged(load(spark, folder, "conversations"))))


ORACLES |= {
    "op1_topk": oracles.TOPK,
    "op2_substring_dedup": oracles.SUBSTRINGS,
    "op3_jaccard_join": oracles.JACCARD,
    "op13_conversations": oracles.CONVERSATIONS,
}
