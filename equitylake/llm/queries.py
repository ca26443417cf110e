"""The registered queries of the corpus operators, and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equitylake.llm import chat, hnsw, lattice, linededup, packing, passages, pieces, pii, quality, simhash, structure, trie, warc
from equitylake.llm.common import table
from equitylake.session import scratch_dir

#: Rows in an Arrow batch: whole texts travel in it.
ARROW_ROWS = 1000


def _with_small_batches(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents`` by 3-word SimHash within two bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector of ``embeddings`` among all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of ``documents`` that another document holds, but in the document that keeps them."""
    return passages.repeated(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of ``documents`` with its bucket, batch and slot."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, P(good) and the decision for every document, by a model of ``labels``."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.graded(table(spark, sf_dir, "labels")), n_grades=3)
    return quality.scores(docs, model, grade=2).withColumn("kept", F.coalesce(F.col("tail") >= 0.5, F.lit(True)))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the spans of personal data in every document."""
    found = pii.span_report(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.BASE_KINDS], F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op7_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of ``embeddings`` at cosine 0.95."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of ``conversations``, repaired and rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text of ``documents``, decoded again."""
    return pieces.encoded(table(spark, sf_dir, "documents"), pieces.PieceModel.load(pieces.MODEL))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that ``documents`` share, dropped but in the largest document, with a digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = linededup.line_index(spark, docs)
    kept = linededup.dedup_lines(docs, index.decide())
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of ``conversations``, each begun with turns of another."""
    rows, convs = trie.spliced(trie.spoken(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(rows, convs).drop("path")


def op12_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation of ``conversations``, damaged first."""
    turns = table(spark, sf_dir, "conversations")
    return structure.structure_report(turns, structure.damaged(turns))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as WARC archives and read back, a row for each record."""
    archives = warc.write_archives(table(spark, sf_dir, "pages"), scratch_dir(spark, "archives"))
    return warc.page_rows(warc.read_archives(archives))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline, all stages."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_ALL = [op1_simhash, op2_hnsw, op3_passages, op4_packing, op5_quality, op6_pii, op7_lattice, op8_chat, op9_pieces,
        op10_line_dedup, op11_trie, op12_structure, op13_warc, pipeline]
QUERIES = {q.__name__: _with_small_batches(q) for q in _ALL}

_KEY = r"""translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

#: CRC-32 of an ASCII text, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)),
            lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, i: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

SQL = {
    "op10_line_dedup": rf"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
            FROM documents),
        keyed AS (SELECT doc_id, pos, line, {_KEY} AS key FROM lines),
        frequent AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
        SELECT doc_id, count(*) AS n_lines,
               count(*) FILTER (WHERE keeper IS NOT NULL AND doc_id <> keeper) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                   FILTER (WHERE keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
        FROM keyed LEFT JOIN frequent USING (key)
        GROUP BY doc_id""",
    "op11_trie": f"""
        WITH own AS (
            SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                                 ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS said
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        begun AS (SELECT own.*, {_CRC32.format(text="conv_id::VARCHAR")} % 9 AS h FROM own),
        spliced AS (
            SELECT a.conv_id, list_concat(coalesce(list_slice(b.said, 1, a.h), []), list_slice(a.said, a.h + 1, len(a.said))) AS said
            FROM begun a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
        members AS (SELECT conv_id, unnest(range(len(said) + 1)) AS depth, said FROM spliced),
        nodes AS (
            SELECT list_slice(said, 1, depth) AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(said) = depth), '')) AS ends_sha256
            FROM members GROUP BY 1, 2),
        kids AS (SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
        sized AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
        below AS (SELECT list_slice(path, 1, up) AS path, n_children, depth, n_convs, path[depth].text AS last
                  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM sized)),
        sums AS (SELECT path, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
                        coalesce(sum((n_convs - 1) * strlen(last)) FILTER (WHERE depth > 0), 0)::BIGINT AS saved_tokens
                 FROM below GROUP BY 1)
        SELECT s.conv_id, s.depth, up.conv_id AS parent_conv_id, s.n_convs, s.n_children, sums.n_leaves, sums.saved_tokens, s.ends_sha256
        FROM sized s JOIN sums USING (path)
        LEFT JOIN sized up ON s.depth > 0 AND up.path = list_slice(s.path, 1, s.depth - 1)""",
    "op13_warc": """
        WITH sized AS (
            SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
            FROM pages)
        SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM sized""",
}
