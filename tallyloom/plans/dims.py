"""Product and branch dimensions: variants, candidates, conflicts, upserts, fixed codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as x
from ..operators.allocation import Chain, clean_variant
from ..operators.orders import newest_first
from ..schemas import D

c = F.col


def product_dim_source(chain: Chain) -> DataFrame:
    """Each product with each variant of name and category among the sales' items: last day seen and rows. Of lines that are written
    already (``Chain.written_once``) their items' names are taken."""
    named = chain.kept.get("variants")
    if named is None:
        items = chain.src.items.where(x.has_product(c("product_no"))).withColumnRenamed("t_open_date", "business_date")
        sold = chain.deal(chain.base.where("order_status = 1").select(*D)).distinct()  # the keys of the newest sales
        named = sold.join(chain.deal(items), D).select("business_date", x.trim_ws(c("product_no")).alias("product_no"), *clean_variant())
    return named.groupBy("product_no", "product_name", "cate_no", "cate_name").agg(F.max("business_date").alias("last_seen"), F.count("*").alias("row_count"))


def branch_dim_source(chain: Chain) -> DataFrame:
    """Each branch of the chosen sales with each name among all raw status 1 rows of those sales and that branch."""
    seen = F.coalesce("modified", "transaction_submitted", "transaction_created", c("business_date").cast("timestamp_ntz"))
    chosen = F.first("branch_id").over(newest_first())
    joined = chain.deal(chain.base.where("order_status = 1")).withColumn("chosen", chosen).where("branch_id = chosen")
    return joined.groupBy("branch_id", "branch_name").agg(F.max(seen).alias("last_seen"), F.count("*").alias("row_count")).withColumn("group_code", F.lit(None).cast("string"))


def _ranked(source: DataFrame, key: str, *names: str) -> DataFrame:
    """Most frequent, then latest, then last by name."""
    order = [F.desc("row_count"), F.desc_nulls_last("last_seen"), *(F.desc_nulls_last(n) for n in names)]
    return source.withColumn("variant_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def product_ranked(source: DataFrame) -> DataFrame:
    return _ranked(source, "product_no", "product_name", "cate_no", "cate_name")


def branch_ranked(source: DataFrame) -> DataFrame:
    return _ranked(source, "branch_id", "branch_name")


def candidates(ranked: DataFrame) -> DataFrame:
    return ranked.where("variant_rank = 1").drop("variant_rank")


def conflict_keys(source: DataFrame, key: str) -> DataFrame:
    return source.groupBy(key).agg(F.count("*").alias("variant_count")).where("variant_count > 1")


def conflict_samples(ranked: DataFrame, key: str, label: Column, n: int = 10) -> DataFrame:
    """The keys with most variants, each with its best three as text. At most three rows of a key are collected."""
    top = conflict_keys(ranked, key).orderBy(F.desc("variant_count"), key).limit(n if n > 0 else 10)
    best = ranked.where("variant_rank <= 3").withColumn("label", label).join(F.broadcast(top), key)
    listed = best.groupBy(key, "variant_count").agg(F.array_sort(F.collect_list(F.struct("variant_rank", "label"))).alias("v"))
    return listed.select(key, "variant_count", F.array_join(F.transform("v", lambda s: s["label"]), " ; ").alias("variants"))


def product_label() -> Column:
    return F.concat(c("product_name"), F.lit("|"), F.coalesce("cate_no", F.lit("")), F.lit("|"), F.coalesce("cate_name", F.lit("")), F.lit("|rows="), c("row_count").cast("string"))


def branch_label() -> Column:
    return F.concat(c("branch_name"), F.lit("|group="), F.coalesce("group_code", F.lit("")), F.lit("|rows="), c("row_count").cast("string"))


def product_dim(candidate: DataFrame, owner: int = 1) -> DataFrame:
    """Candidates in the shape of the dimension."""
    return candidate.select(F.lit(owner).cast("bigint").alias("owner_user_id"), "product_no", "product_name", x.normalize_name(c("product_name")).alias("product_name_normalized"), "cate_no", "cate_name", F.lit(True).alias("is_active"), c("last_seen").cast("timestamp_ntz").alias("last_seen_at"))


def branch_dim(candidate: DataFrame, owner: int = 1) -> DataFrame:
    return candidate.select(F.lit(owner).cast("bigint").alias("owner_user_id"), "branch_id", "branch_name", x.normalize_name(c("branch_name")).alias("branch_name_normalized"), "group_code", F.lit(True).alias("is_active"), c("last_seen").cast("timestamp_ntz").alias("last_seen_at"))


def upsert(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``current`` with the rows of ``new`` put in by owner and key: new values win, the last sight isn't lost, other keys stay."""
    keys = ["owner_user_id", key]
    a, b = current.alias("a"), new.withColumn("__new", F.lit(True)).alias("b")
    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full_outer")
    pick = lambda n: F.coalesce(f"b.{n}", f"a.{n}") if n in (*keys, "last_seen_at") else F.when(c("b.__new"), c(f"b.{n}")).otherwise(c(f"a.{n}"))
    return joined.select(*(pick(n).alias(n) for n in current.columns))


def code_dims(spark: SparkSession) -> DataFrame:
    """All fixed codes: kind, id, code."""
    rows = [(k, i, n) for k, d in (("order_type", x.ORDER_TYPES), ("payment_type", x.PAYMENT_TYPES), ("status", x.STATUSES)) for i, n in d.items()]
    return spark.createDataFrame(rows, "kind string, id int, code string")


def reseed(current: DataFrame, codes: DataFrame) -> DataFrame:
    """``current`` codes (kind, id, code) with the fixed ones put in: labels are overwritten, other ids stay."""
    own = codes.withColumnRenamed("code", "__code")
    return current.join(F.broadcast(own), ["kind", "id"], "full_outer").select("kind", "id", F.coalesce("__code", "code").alias("code"))
