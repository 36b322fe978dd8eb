"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from flowmart.llm import consensus_html, neighbours
from flowmart.llm.block_naming import exact_groups
from flowmart.llm.bpe import token_round_trip
from flowmart.llm.contamination import with_contamination
from flowmart.llm.fragments import jaccard_components
from flowmart.llm.line_templates import without_recurring_lines
from flowmart.llm.max_sketches import rank
from flowmart.llm.merkle import fold, leaf_digest, manifest, proof_digest
from flowmart.llm.near_duplicates import near_components
from flowmart.llm.rank_profiles import held_out, languages
from flowmart.llm.token_records import read_records, write_records
from flowmart.llm.warc import read_captures, write_archive
from flowmart.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "archive")
    write_archive(pages(spark, sf_dir), folder)
    return read_captures(spark, folder, pages(spark, sf_dir)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_recurring_lines(documents(spark, sf_dir))


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    write_records(documents(spark, sf_dir), folder, TOKENIZER)
    return read_records(spark, folder, TOKENIZER)


def op4_consensus_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = consensus_html.extract(pages(spark, sf_dir), "main_text")
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))


def op5_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir), size=3, percent=85).drop("text_mark")


def op6_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "found")
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        "found.n_items",
        F.sha2(F.concat_ws(",", "found.items").cast("binary"), 256).alias("items_sha256"),
        "found.contaminated",
    )


def op7_rank_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(documents(spark, sf_dir))


def op8_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    marked = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id", 3, 1))
    model = neighbours.fit(docs, marked.select("doc_id", F.col("quality").alias("label")))
    scored = docs.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), neighbours.score("text", model, spark).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


def op10_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = token_round_trip(documents(spark, sf_dir), TOKENIZER)
    return made.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_vertical_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), size=5, percent=80).drop("text_mark")


def op12_time_forward_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(changed, leaf_digest(text=F.translate("text", "\n", ""))).otherwise(leaf_digest())
    made = manifest(documents(spark, sf_dir), tampered).withColumn("folded_root", fold(F.col("kept"), F.col("proof")))
    return made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_max_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50).drop("text_mark")


REGISTRY = {
    "op1_capture_index": op1_capture_index,
    "op2_line_templates": op2_line_templates,
    "op3_token_records": op3_token_records,
    "op4_consensus_html": op4_consensus_html,
    "op5_hyperminhash": op5_hyperminhash,
    "op6_prefix_join": op6_prefix_join,
    "op7_rank_profiles": op7_rank_profiles,
    "op8_neighbour_votes": op8_neighbour_votes,
    "op9_block_naming": op9_block_naming,
    "op10_transducer": op10_transducer,
    "op11_vertical_fragments": op11_vertical_fragments,
    "op12_time_forward_manifest": op12_time_forward_manifest,
    "op13_max_sketches": op13_max_sketches,
}

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SPACED = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"
_BASE32 = " || ".join(
    f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || substr(sha, {5 * k + 1}, 5))::INTEGER >> {shift}) & 31)]"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)



def _components_sql(size: int, percent: int, more: str = "") -> str:
    return f"""
        WITH RECURSIVE cut AS (
            SELECT doc_id, {_SPACED.format(_LOWER.format('text'))} AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE
                WHEN len(w) = 0 THEN CAST([] AS VARCHAR[][])
                WHEN len(w) < {size} THEN [w]
                ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: w[i:i + {size - 1}]))
                END AS shingles
            FROM cut),
        classes AS (
            SELECT list_sort(shingles) AS shingles, len(shingles) AS n, min(doc_id) AS rep
            FROM sets WHERE len(shingles) > 0 GROUP BY ALL),
        items AS (SELECT rep, n, hash(unnest(shingles)) AS s FROM classes),
        shared AS (
            SELECT a.rep AS x, b.rep AS y, count(*) AS k, any_value(a.n) + any_value(b.n) AS total
            FROM items a JOIN items b ON a.s = b.s AND a.rep < b.rep
            WHERE 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
            GROUP BY ALL),
        links AS (
            SELECT x, y FROM shared WHERE 100 * k >= {percent} * (total - k)
            UNION ALL SELECT y, x FROM shared WHERE 100 * k >= {percent} * (total - k)),
        reach AS (
            SELECT rep AS x, rep AS y FROM classes
            UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
        named AS (SELECT x AS rep, min(y) AS component_id FROM reach GROUP BY x)
        SELECT doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles,
               coalesce(component_id, doc_id) AS component_id{more}
        FROM sets s
        LEFT JOIN classes c ON c.shingles = list_sort(s.shingles)
        LEFT JOIN named USING (rep)
    """


def _digest_part(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf_sql(text: str = "text") -> str:
    return "sha256(" + " || ".join(_digest_part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels_sql(base: str) -> str:
    """Nodes of all levels of trees, each level as one list."""
    return f"""
            {base}
            UNION ALL
            SELECT tree, level + 1,
                   list_transform(range(1, len(nodes) + 1, 3), lambda i: sha256(array_to_string(nodes[i:i + 2], '')))
            FROM here WHERE len(nodes) > 1"""


def _step_sql(place: str) -> str:
    """Siblings left and right of the node above `place`, with a bar between them."""
    own = f"({place} // CAST(3 ** (level % 1000) AS BIGINT))"
    return f"""array_to_string(list_filter(nodes, lambda x, k: (k - 1) // 3 = {own} // 3 AND k - 1 < {own}), '')
               || '|' || array_to_string(list_filter(nodes, lambda x, k: (k - 1) // 3 = {own} // 3 AND k - 1 > {own}), '')"""


ORACLES = {
    "op1_capture_index": f"""
        WITH hashed AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
            FROM pages)
        SELECT page_id,
               CAST(strlen(body) AS BIGINT) AS payload_bytes,
               {_BASE32} AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM hashed
    """,
    "op5_hyperminhash": _components_sql(3, 85, ", doc_id = coalesce(component_id, doc_id) AS kept"),
    "op6_prefix_join": f"""
        WITH items AS (
            SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(_LOWER.format('text'))} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item, w[i:i + least(13, len(w)) - 1] AS win, least(13, len(w)) AS size
            FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
                  FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM windows),
        docs AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
        places AS (
            SELECT doc_id, i, size, w[i:i + size - 1] AS win
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)),
        found AS (SELECT doc_id, i, p.size, item FROM places p JOIN windows v ON p.win = v.win),
        hits AS (
            SELECT doc_id, count(DISTINCT word) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM found) GROUP BY doc_id),
        listed AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
    "op9_block_naming": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_vertical_fragments": _components_sql(5, 80),
    "op12_time_forward_manifest": f"""
        WITH RECURSIVE bits AS (
            SELECT list(v ORDER BY i) AS crc FROM (
                SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM (SELECT unnest(range(256)) AS i))),
        leaves AS (
            SELECT doc_id, source, text, {_leaf_sql()} AS leaf, {_leaf_sql("replace(text, chr(10), '')")} AS changed,
                   xor(list_reduce(list_prepend(4294967295,
                           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
                       lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS sum
            FROM documents, bits),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
        lower AS (WITH RECURSIVE here AS ({_levels_sql("""
            SELECT source AS tree, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source""")})
            SELECT * FROM here),
        subroots AS (
            SELECT tree AS source, nodes[1] AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS number
            FROM lower WHERE len(nodes) = 1),
        upper AS (WITH RECURSIVE here AS ({_levels_sql("""
            SELECT 0 AS tree, 0 AS level, list(subroot ORDER BY number) AS nodes FROM subroots""")})
            SELECT * FROM here),
        steps AS (
            SELECT doc_id, leaf, level, {_step_sql("place")} AS step
            FROM placed JOIN lower ON source IS NOT DISTINCT FROM tree WHERE len(nodes) > 1
            UNION ALL
            SELECT doc_id, leaf, 1000 + level, {_step_sql("number")}
            FROM placed JOIN subroots ON placed.source IS NOT DISTINCT FROM subroots.source, upper WHERE len(nodes) > 1),
        proofs AS (SELECT doc_id, leaf, list(step ORDER BY level) AS steps FROM steps GROUP BY doc_id, leaf),
        whole AS (
            SELECT p.doc_id, p.leaf, subroot, (SELECT nodes[1] FROM upper WHERE len(nodes) = 1) AS root,
                   coalesce(steps, []) AS steps, CASE WHEN sum % 2 = 0 THEN changed ELSE p.leaf END AS given
            FROM placed p
            JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
            LEFT JOIN proofs q ON p.doc_id IS NOT DISTINCT FROM q.doc_id AND p.leaf = q.leaf),
        folded AS (
            SELECT *, list_reduce(list_prepend(given, steps),
                lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2))) AS folded_root
            FROM whole)
        SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folded
    """,
    "op13_max_sketches": f"""
        WITH cut AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
        total AS (
            SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM cut WHERE len(w) > 0),
        lengths AS (SELECT doc_id, 50 + (50 * len(w) * docs) // words AS m FROM cut, total WHERE len(w) > 0),
        counted AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM cut) GROUP BY ALL),
        weights AS (
            SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight
            FROM (SELECT t, count(*) AS df FROM counted GROUP BY t), total),
        asked AS (
            SELECT DISTINCT item_id, t
            FROM (SELECT item_id, unnest({_WORDS.format(_LOWER.format('text'))}) AS t FROM benchmark)),
        scored AS (
            SELECT item_id, doc_id,
                   CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM asked JOIN weights USING (t) JOIN counted USING (t) JOIN lengths USING (doc_id)
            GROUP BY ALL)
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
              FROM scored WHERE score > 0)
        WHERE place <= 50
    """,
}
