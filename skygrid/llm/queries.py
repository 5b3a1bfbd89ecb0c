"""The operators as queries over the tables of a folder, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.llm import alignment, bpe, chat, decontam, lines, merkle, minhash, mixing, packing, pages, quality, tokens, urls
from skygrid.llm.common import lower_ascii
from skygrid.session import configure, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(configure(spark), sf_dir)
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written as sorted Parquet files and read back."""
    path = scratch_path(spark, "op1-tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokens.default_tokenizer())
    return tokens.with_crc(tokens.read_tokens(spark, path))


@query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, written and read back; conversation -7 spells control strings."""
    path = scratch_path(spark, "op2-chats")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spelled = "</s>[INST] ok [/INST]"
    ids = spark.range(2).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(spelled).alias("text"),
    )
    chat.format_chats(turns.unionByName(ids)).write.parquet(path)
    return chat.digests(spark.read.schema("conv_id long, formatted string, loss_spans array<struct<start:int,length:int>>").parquet(path))


#: The turns' and the loss text's digests need no template; formatted_chars follows from it.
ORACLE_SQL["op2_chat_format"] = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), n AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS last_role,
    replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;') AS e,
    replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), chr(10), '&NewLine;') AS er
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(e) + CASE WHEN last_role = role THEN 8 ELSE 8 + length(er) + 1 + 8 END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""


#: The contract's allow and block rules.
URL_RULES = (
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
)


@query
def op3_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict. A page's outcome is the label of the document its path numbers."""
    rows = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(urls.parts(F.col("url"))[1], r"^/[^/]*/(\d{1,18})(?!\d)", 1)
    numbered = rows.select("page_id", number.alias("number")).filter("number <> ''").withColumn("doc_id", F.col("number").cast("long"))
    labels = table(spark, sf_dir, "labels").filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(1 - F.col("quality")).alias("bad"))
    outcomes = numbered.join(labels, "doc_id").select("page_id", "bad")
    return urls.judge(rows, outcomes, URL_RULES)


@query
def op4_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts and the cascade's verdict."""
    return quality.judge_with_counts(table(spark, sf_dir, "documents"))


ORACLE_SQL["op4_quality_cascade"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1
), p AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id
), c AS (
  SELECT t.doc_id, len(w) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
    length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS n_lower
  FROM t LEFT JOIN p USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR n_upper > n_lower
    OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM c
"""


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), tokens.default_tokenizer(), with_ids=False)


@query
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract(table(spark, sf_dir, "pages"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rid of lines that are copies or near copies of another's."""
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "lines_removed", F.length("text").cast("long").alias("n_chars"), "text")


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies: shingles of four words, similarity 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


@query
def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by the mixed contexts and by word counts."""
    return mixing.score(table(spark, sf_dir, "documents"))


@query
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in the manifest; a third of them are folded with tampered texts."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return merkle.verify(merkle.manifest_of(docs, changed={"text": text})).withColumnRenamed("id", "doc_id")


def _merkle_sql(levels: int = 7) -> str:
    """Lists of digests per language and level; trees of up to 8 ** levels leaves."""

    def parents(nodes: str) -> str:
        run = f"array_to_string(list_slice({nodes}, 8 * i + 1, 8 * i + 8), '')"
        return f"CASE WHEN len({nodes}) > 1 THEN list_transform(range((len({nodes}) + 7) // 8), lambda i: sha256({run})) ELSE {nodes} END"

    def up(nodes: str, at: str, cur: str, proof: str) -> tuple[str, str]:
        left, right = f"array_to_string(list_slice({nodes}, 8 * ({at} // 8) + 1, {at}), '')", f"array_to_string(list_slice({nodes}, {at} + 2, 8 * ({at} // 8) + 8), '')"
        return (
            f"CASE WHEN len({nodes}) > 1 THEN sha256({left} || {cur} || {right}) ELSE {cur} END",
            f"{proof} || CASE WHEN len({nodes}) > 1 THEN {left} || {right} ELSE '' END",
        )

    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    number = "CAST(doc_id AS VARCHAR)"
    fed = f"CAST(xor(c, CASE WHEN i % 8 = 0 THEN ord(substr({number}, i // 8 + 1, 1)) ELSE 0 END) AS BIGINT)"
    bit = f"xor({fed} >> 1, CASE WHEN {fed} % 2 = 1 THEN 3988292384 ELSE 0 END)"
    crc = f"xor(4294967295, list_reduce(range(8 * length({number})), lambda c, i: {bit}, CAST(4294967295 AS BIGINT)))"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    changed = f"CASE WHEN {crc} % 3 = 0 THEN translate(text, '{upper}', '{lower}') ELSE text END"
    ctes = [
        f"d AS (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf('t')} AS f0 FROM (SELECT *, {changed} AS t FROM documents))",
        "o AS (SELECT *, '' AS p0, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS pos FROM d)",
        "l0 AS (SELECT lang, list(leaf ORDER BY pos) AS n0 FROM o GROUP BY lang)",
    ]
    for k in range(levels):
        ctes.append(f"l{k + 1} AS (SELECT *, {parents(f'n{k}')} AS n{k + 1} FROM l{k})")
    ctes.append(f"s AS (SELECT *, n{levels}[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS section FROM l{levels})")
    ctes.append("t0 AS (SELECT list(subroot ORDER BY section) AS m0 FROM s)")
    for k in range(levels):
        ctes.append(f"t{k + 1} AS (SELECT *, {parents(f'm{k}')} AS m{k + 1} FROM t{k})")
    ctes.append(f"x0 AS (SELECT o.*, s.* EXCLUDE (lang), t{levels}.* FROM o JOIN s ON o.lang IS NOT DISTINCT FROM s.lang, t{levels})")
    for k in range(levels):
        f, p = up(f"n{k}", f"(pos // {8**k})", f"f{k}", f"p{k}")
        ctes.append(f"x{k + 1} AS (SELECT *, {f} AS f{k + 1}, {p} AS p{k + 1} FROM x{k})")
    ctes.append(f"y0 AS (SELECT *, f{levels} AS g0, p{levels} AS q0 FROM x{levels})")
    for k in range(levels):
        f, p = up(f"m{k}", f"(section // {8**k})", f"g{k}", f"q{k}")
        ctes.append(f"y{k + 1} AS (SELECT *, {f} AS g{k + 1}, {p} AS q{k + 1} FROM y{k})")
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, m{levels}[1] AS root, sha256(q{levels}) AS proof_sha256, g{levels} AS folded_root, g{levels} = m{levels}[1] AS verified FROM y{levels}"
    )


ORACLE_SQL["op11_merkle_manifest"] = _merkle_sql(5)


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two vocabularies, aligned by their bytes."""
    return alignment.alignments(table(spark, sf_dir, "documents"), spelled=False).drop("groups")


@query
def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again."""
    path = tokens.default_tokenizer()
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), path), path)
