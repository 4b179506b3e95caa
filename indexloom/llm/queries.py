"""The operators of this package applied to the supplied tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.llm import exact_dedup, jaccard, language, mixing, neighbours, packing, periodic_runs, secret_scan, suffix_dedup, token_counts, toxicity, url_filter, vector_codes


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return suffix_dedup.removed_spans(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, url_filter.rules_frame(spark), url_filter.page_links(pages))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.quantize(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return codes.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(vector_codes.codebooks_sha256(books)).alias("codebooks_sha256"))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by id, gets a root that repeats from some word on, as the query's contract has it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    split = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"))
    placed = split.withColumn("n", F.size("words").cast("long"))
    placed = placed.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    root = F.slice("words", F.col("a").cast("int") + 1, F.col("p"))
    tail = (F.col("n") - F.col("a")).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(root, F.ceil(tail / F.col("p")).cast("int"))), F.lit(1), tail)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), repeated), " ")
    return placed.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_with_repeats(_table(spark, sf_dir, "documents")))
    first = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] * y["period"] != y["length"] * x["period"], F.sign(y["length"] * x["period"] - x["length"] * y["period"]))
                               .when(x["start"] != y["start"], F.sign(x["start"] - y["start"])).otherwise(F.sign(x["period"] - y["period"])).cast("int")), F.lit(0))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))), "\n")
    best = found.withColumns({"best": first, "listed": F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")})
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE]

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kinds(kinds: list[str]) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(kinds))

    counts = [F.size(of_kinds([kind])).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select("doc_id", *counts, F.sha2(listed(of_kinds(base)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_token_counts, op3_exact_dedup, op4_neighbours, op5_toxicity, op6_jaccard, op7_language, op8_mixing, op9_url_filter, op10_packing, op11_vector_codes, op12_periodic_runs, op13_secret_scan, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": exact_dedup.SQL, "op8_mixing": mixing.SQL, "op9_url_filter": url_filter.SQL, "op11_vector_codes": vector_codes.SQL, "op12_periodic_runs": periodic_runs.SQL, "op13_secret_scan": secret_scan.SQL}
