"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import byte_bpe, decontamination, exact_dedup, jaccard_join, language_id, merkle, periods, recurrent, site_tree, substring_dedup, token_counts, toxicity, warc
from changelake.llm.columns import table, text_or_empty

#: Tokens above which a text exceeds a model's context.
TOKEN_LIMIT = 2048
#: The pages' table has no dates; all count as taken then.
TAKEN = "2024-01-01T00:00:00Z"


def fold_of(parts: int) -> Column:
    """Remainder of the checksum that assigns documents to folds."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.page_responses(table(spark, sf_dir, "pages"), TAKEN), "page_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = fold_of(5) == 0
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    model = toxicity.learn(documents, labels, "doc_id", "text", "toxic")
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.extract(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = fold_of(4) == 2
    model = language_id.learn(documents.filter(~held_out), "doc_id", "text", "lang")
    found = language_id.identify(documents, model)
    return found.withColumn("held_out", held_out)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary, limit=TOKEN_LIMIT)


def op11_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold_of(10) == 0, F.lit(False))
    found = recurrent.log_likelihoods(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _planted(documents: DataFrame) -> DataFrame:
    """`text` of every tenth document, by checksum, with a part repeated up to its end, as the query's contract asks."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    found = F.array_remove(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), "")
    rows = documents.select("doc_id", "text", F.when(checksum % 10 == 0, found).alias("w"), F.floor(checksum / 10).alias("g"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    rows = rows.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    part = F.slice("w", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(part, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), repeated), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find_runs(_planted(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")

    def longer(best: Column, run: Column) -> Column:
        # Runs come by start, then period, so the first of equal ones stays.
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    found = found.withColumn("best", F.aggregate("runs", none, longer))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    tampered = F.when(fold_of(2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    found = merkle.manifest(documents, columns, altered={"text": tampered})
    found = found.withColumn("folded_root", merkle.fold(F.col("path"), F.col("altered_leaf")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_language_id": op9_language_id,
    "op10_token_counts": op10_token_counts,
    "op11_recurrent_lm": op11_recurrent_lm,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: Words of all documents in order; lower-cased ASCII for the shingles.
_WORDS = r"""
    words AS (
        SELECT doc_id, list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    )"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Unsigned CRC-32 of a decimal id.
_CRC32 = """
    crc_table AS (
        SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS steps
        FROM range(256) AS r(n)
    ),
    checksums AS (
        SELECT doc_id, xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
            lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])
        )) AS checksum
        FROM (SELECT DISTINCT doc_id FROM documents), crc_table
    )"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _levels(name: str, start: str) -> str:
    """Lists of the nodes of each level."""
    parents = "list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], '')))"
    return f"{name} AS ({start} UNION ALL SELECT tree, level + 1, {parents} FROM {name} WHERE len(nodes) > 1)"


def _walk(name: str, levels: str, start: str) -> str:
    """Leaves climbing the levels, with the siblings met and the digest folded so far."""
    left = "array_to_string(list_filter(nodes, lambda x, i: i - 1 >= place - place % 3 AND i - 1 < place), '')"
    right = "array_to_string(list_filter(nodes, lambda x, i: i - 1 > place AND i - 1 < place - place % 3 + 3), '')"
    return f"""{name} AS (
        {start}
        UNION ALL
        SELECT leaf_row, tree, level + 1, place // 3, siblings || {left} || {right}, sha256({left} || folded || {right})
        FROM {name} JOIN {levels} USING (tree, level) WHERE len(nodes) > 1
    )"""


ORACLE: dict[str, str] = {
    "op4_jaccard_join": f"""
        WITH RECURSIVE {_WORDS.format(text=_LOWER)},
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
            FROM words
        ),
        shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
        several AS (SELECT shingle FROM shingles GROUP BY shingle HAVING count(*) > 1),
        shared AS (SELECT doc_id, n, shingle FROM shingles SEMI JOIN several USING (shingle)),
        links AS (
            SELECT a.doc_id AS u, b.doc_id AS v
            FROM shared a JOIN shared b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
                AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ),
        reached AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION
            SELECT doc_id, v FROM reached JOIN links ON other = u
        )
        SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
        FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
    """,
    "op5_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(content) AS text_sha256
        FROM texts
        WINDOW same AS (PARTITION BY content)
    """,
    "op7_substring_dedup": f"""
        WITH {_WORDS.format(text="coalesce(text, '')")},
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS content
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)
        ),
        first AS (SELECT content, min(doc_id) AS least FROM windows GROUP BY content HAVING min(doc_id) < max(doc_id)),
        gone AS (
            SELECT DISTINCT doc_id, i + k AS place
            FROM windows JOIN first USING (content), unnest(range(13)) AS t(k)
            WHERE doc_id > least
        ),
        placed AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS word FROM words),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
            FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE {_CRC32},
        leaves AS (
            SELECT doc_id, coalesce('=' || source, '-') AS tree, {_leaf("text")} AS leaf,
                   CASE WHEN checksum % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS altered
            FROM documents LEFT JOIN checksums USING (doc_id)
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS leaf_row
            FROM leaves
        ),
        {_levels("levels", "SELECT tree, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY tree")},
        subroots AS (SELECT tree AS of, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS top FROM levels WHERE len(nodes) = 1),
        {_levels("tops", "SELECT '' AS tree, 0 AS level, list(subroot ORDER BY top) AS nodes FROM subroots")},
        {_walk("walk", "levels", "SELECT leaf_row, tree, 0 AS level, place, '' AS siblings, altered AS folded FROM placed")},
        below AS (SELECT walk.* FROM walk JOIN levels USING (tree, level) WHERE len(nodes) = 1),
        {_walk("climb", "tops", "SELECT leaf_row, '' AS tree, 0 AS level, top AS place, siblings, folded FROM below JOIN subroots ON below.tree = of")},
        proofs AS (SELECT climb.*, nodes[1] AS root FROM climb JOIN tops USING (tree, level) WHERE len(nodes) = 1)
        SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM placed JOIN proofs USING (leaf_row) JOIN subroots ON placed.tree = of
    """,
}
