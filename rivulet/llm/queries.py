"""The registered ``opN_*`` queries: each applies its operator to its whole table and derives
the columns of its result contract.  ORACLE_SQL holds DuckDB SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import oracle
from rivulet.session import configure
from rivulet.sources.tables import read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.lines import apply_bitmaps, line_keep_bitmaps
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    bitmaps = line_keep_bitmaps(docs, min_docs=10, min_chars=1, keep_first=False)
    return apply_bitmaps(docs, bitmaps).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.exact import exact_groups
    return exact_groups(read_table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.substrings import kept_bytes, repeated_spans
    found = repeated_spans(read_table(spark, sf_dir, "documents", "doc_id", "text"), length=400)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
                        removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                        F.sha2(kept_bytes(F.col("text"), F.col("spans")), 256).alias("kept_sha256"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.simhash import fingerprint_hex, simhash_groups
    groups = simhash_groups(read_table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, max_bits=2)
    return groups.select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.secrets import find_secrets
    found = find_secrets(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op3_html_min_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.html import extract_text
    return extract_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op4_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.common import shared_folder
    from rivulet.llm.huffman import read_ids, write_ids
    from rivulet.llm.units import tokenizer_settings
    folder = shared_folder(spark, "token-ids")
    write_ids(read_table(spark, sf_dir, "documents", "doc_id", "text"), folder, tokenizer_settings(tokenizer_path("word_bpe_49k.json")), end_id=2)
    return read_ids(spark, folder, sums_only=True).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc").alias("ids_crc32"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.quality import quality_rules
    return quality_rules(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.mixing import mix_sources
    return mix_sources(read_table(spark, sf_dir, "documents", "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.packing import pack_documents
    from rivulet.llm.units import tokenizer_settings
    packed = pack_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                            tokenizer_settings(tokenizer_path("byte_bpe_50k.json")), end_id=2, size=1024)
    return packed.select("doc_id", "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.minhash import minhash_groups
    return minhash_groups(read_table(spark, sf_dir, "documents", "doc_id", "text"), shingle=4, percent=80)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.trie import prefix_trie, rebuilt
    turns, convs = rebuilt(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return prefix_trie(turns, convs)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivulet.llm.phrases import collocations
    return collocations(read_table(spark, sf_dir, "documents", "lang", "text"), min_count=10, top=2000, inside_percent=50)


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


BUILDERS = {f.__name__: f for f in (
    op1_line_dedup, op2_secret_scan, op3_html_min_cut, op4_huffman_ids, op5_quality_rules,
    op6_exact_dedup, op7_mix_sources, op8_suffix_dedup, op9_simhash_near_dedup, op10_best_fit_packing,
    op11_minhash_near_dedup, op12_conversation_trie, op13_phrase_collocations)}


def _configured(fn):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    return build


def queries():
    return {name: _configured(fn) for name, fn in BUILDERS.items()}


def oracle_sql():
    return {name: sql for name, sql in oracle.ORACLE_SQL.items() if name in BUILDERS}
