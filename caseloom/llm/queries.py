"""The registered query of each corpus operator: production parameters over the whole table it is meant for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import ordinal, toxicity
from caseloom.llm.bpe import round_trip_digests
from caseloom.llm.decontaminate import contamination
from caseloom.llm.forest import near_duplicates
from caseloom.llm.packing import packed_sequences
from caseloom.llm.pages import main_text
from caseloom.llm.phrases import collocations
from caseloom.llm.quotient import exact_duplicates
from caseloom.llm.repair import damaged, repaired
from caseloom.llm.ring import ring_shards
from caseloom.llm.suffix import remove_repeated_bytes
from caseloom.llm.superkmer import remove_repeated_windows
from caseloom.plans.catalog import Catalog

catalog = Catalog()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public tokenizer of the encoding queries, where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@catalog.query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(table(spark, sf_dir, "documents"))


@catalog.query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


@catalog.query("op4_exact_dedup", """
    WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
    SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256 FROM n JOIN g USING (text_sha256)""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@catalog.query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring_shards(table(spark, sf_dir, "documents"))
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@catalog.query("op9_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@catalog.query("op8_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@catalog.query("op10_ngram_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "group_key")


@catalog.query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@catalog.query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordinal.graded(docs, ordinal.train(docs, ordinal.quality_grades(table(spark, sf_dir, "labels")), 3))


@catalog.query("op1_main_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@catalog.query("op11_collocations", r"""
    WITH pieces AS (
        SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w
        FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
    f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) t(k))
        GROUP BY ALL HAVING count(*) >= 30),
    long AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
    cut AS (SELECT lang, phrase, f AS a, w, k, unnest(range(1, k)) AS c FROM long),
    scored AS (SELECT cut.lang, cut.phrase, cut.a, x.f AS l, y.f AS r, c, CAST((2000000::HUGEINT * cut.a) // (x.f + y.f) AS BIGINT) AS score
        FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:c], ' ')
        JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[c + 1:], ' ')),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
    inner_part AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS longer
        FROM (SELECT lang, w, f, s, unnest(range(1, k - s + 2)) AS i FROM long, (VALUES (2), (3)) t(s) WHERE s < k) GROUP BY ALL),
    kept AS (SELECT lowest.* FROM lowest LEFT JOIN inner_part USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@catalog.query("op12_best_fit_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_sequences(table(spark, sf_dir, "documents"), tokenizer_path())


@catalog.query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")))
