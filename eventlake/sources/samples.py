"""Adapters from generic benchmark tables to the shapes of this library.

The tables (events, part, orders, documents, ...) stand in for the message
streams: each row becomes one message or one canonical row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import EventRoles
from eventlake.functions.text import Lexicon
from eventlake.operators.joins import join_dimension

ROLES = EventRoles(search="signup", view="view", cart="click", purchase="purchase")

# Words that occur in the generated prose; "the" and "then" overlap on purpose.
LEXICON = Lexicon(
    positive=("best", "great", "then", "the", "with", "jardin", "schö"),
    negative=("hand", "ther", "fin", "der ", "que ", "reda"),
)
ASPECTS = {
    "delivery": ("ship", "liefer", "wher"),
    "quality": ("best", "great", "onon"),
    "price": ("sale", "cost", "pour"),
    "size": ("small", "heth", "gro"),
    "design": ("color", "rouge", "blau", "ndndnd"),
}
# Words of the product names.
VOCABULARY = (
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old",
    "plate", "red", "ring", "rod", "small", "widget",
)
PATTERNS = (
    ("natural", "gift"),
    ("comparison", " vs |review"),
    ("specific", "sale|free shipping"),
    ("recommendation", "best |top "),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(parts: DataFrame) -> DataFrame:
    return parts.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
    )


def events(raw: DataFrame, roles: EventRoles = ROLES) -> DataFrame:
    """Canonical events without the product's own columns."""
    when = F.col("ts").cast("timestamp")
    bought = F.col("event_type") == roles.purchase
    return raw.select(
        "event_id", "event_type", "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        F.when(bought, F.col("value").cast("decimal(18,2)")).alias("total_amount"),
        when.alias("event_timestamp"),
        F.to_date(when).alias("event_date"),
        F.hour(when).alias("event_hour"),
    )


def enriched_events(raw: DataFrame, parts: DataFrame, roles: EventRoles = ROLES) -> DataFrame:
    return join_dimension(events(raw, roles), products(parts), "product_id")


def iso(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def event_messages(raw: DataFrame, *beside: str) -> DataFrame:
    """One shopping event message per row; amounts in whole cents. `beside`: expressions to keep with it."""
    key = F.get_json_object("props", "$.k").cast("long")
    bought = F.col("event_type") == ROLES.purchase
    when = F.col("ts").cast("timestamp")
    campaign = F.when(key % 3 == 0, F.struct(
        F.concat(F.lit("camp_"), key % 4).alias("id"), F.concat(F.lit("campaign "), key % 4).alias("name"),
    ))
    body = F.struct(
        F.concat(F.lit("ev_"), "event_id").alias("event_id"),
        "event_type",
        F.concat(F.lit("u_"), "user_id").alias("user_id"),
        F.concat(F.lit("pd_"), F.lpad(key.cast("string"), 6, "0")).alias("product_id"),
        F.concat(F.lit("category "), key % 5).alias("category"),
        (key * 1000).alias("price"),
        iso(when).alias("timestamp"),
        F.struct(
            F.when(key % 2 == 0, "mobile").otherwise("desktop").alias("type"),
            F.concat(F.lit("os "), key % 3).alias("os"),
            F.lit("1.0").alias("app_version"),
        ).alias("device"),
        F.struct(F.lit("direct").alias("referrer"), campaign.alias("campaign")).alias("context"),
        F.when(bought, 1 + key % 3).alias("quantity"),
        F.when(bought, (F.col("value").cast("decimal(18,2)") * 100).cast("long")).alias("total_amount"),
        F.when(bought, F.lit("card")).alias("payment_method"),
        F.struct(F.lit("not in the schema").alias("sdk_version")).alias("metadata"),
    )
    return raw.select(*map(F.expr, beside), F.to_json(body).alias("value"))


def campaigns(parts: DataFrame) -> DataFrame:
    """One campaign per product for some hours of January 2024; every fiftieth lasts for weeks, some end at once."""
    key = F.col("p_partkey")
    start = F.timestamp_seconds(F.lit(1_704_067_200) + (key * 7 % 720) * 3600 + key % 60 * 60)
    hours = F.when(key % 50 == 0, 24 * 20).otherwise(key % 37)
    return parts.select(
        F.concat(F.lit("camp_"), key).alias("campaign_id"), (key % 4).alias("segment"), start.alias("starts_at"),
        F.timestamp_seconds(F.unix_seconds(start) + hours * 3600).alias("ends_at"),
    )


def branded_products(parts: DataFrame) -> DataFrame:
    """Products of which some have no brand, and some are not listed at all."""
    known = products(parts).filter("product_id % 29 <> 3")
    return known.withColumn("brand", F.when(F.col("product_id") % 7 != 0, F.col("brand")))


def faulty_event_messages(raw: DataFrame) -> DataFrame:
    """Event messages with faults that follow from the event's number: cut off, without key, without time."""
    value = (
        F.when(F.col("number") % 97 == 0, F.left("value", F.lit(25)))
        .when(F.col("number") % 89 == 0, F.regexp_replace("value", '"event_id"', '"event"'))
        .when(F.col("number") % 83 == 0, F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"soon"'))
        .otherwise(F.col("value"))
    )
    return event_messages(raw, "event_id AS number").select("number", value.alias("value"))


def faulty_events(enriched: DataFrame) -> DataFrame:
    """Rows with lost times, users and amounts, repeated ids, and the day on which each arrived."""
    number = F.col("event_id")

    def without(column: str, divisor: int) -> Column:
        return F.when(number % divisor != 0, F.col(column))

    arrival = F.date_add("event_date", (number % 67 == 0).cast("int"))
    return enriched.withColumns({
        "arrival_date": arrival,
        "event_timestamp": without("event_timestamp", 83),
        "event_date": without("event_date", 83),
        "user_id": without("user_id", 79),
        "total_amount": without("total_amount", 71),
        "event_id": F.when(number % 73 == 0, number - 1).otherwise(number),
    })


def session_messages(orders: DataFrame) -> DataFrame:
    """One session message per order: a view, and by its columns a search, a cart and a purchase."""
    key = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("timestamp")
    seconds = 60 + key % 600
    searched = key % 4 == 0
    carted = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    bought = F.col("o_orderstatus") == "F"

    def event(index: int, kind: str, page: str, *extra: Column) -> Column:
        return F.struct(
            F.lit(index).alias("event_index"),
            F.lit(kind).alias("event_type"),
            iso(F.timestamp_seconds(F.unix_seconds(start) + index)).alias("timestamp"),
            F.lit(page).alias("page"),
            (key % 50).alias("duration_on_page"),
            *extra,
        )

    def product(number: Column) -> Column:
        return F.struct(
            F.concat(F.lit("pd_"), number).alias("product_id"),
            F.concat(F.lit("category "), number % 5).alias("category"),
            (number * 100).alias("price"),
            F.lit(1).alias("quantity"),
        )

    viewed, bagged = key % 1000, key % 999
    no_product = F.lit(None).cast("struct<product_id:string,category:string,price:bigint,quantity:int>")
    no_search = F.lit(None).cast("struct<query:string,result_count:bigint,filters:array<string>>")
    no_deal = F.lit(None).cast("struct<transaction_id:string,payment_method:string,total_amount:bigint>")
    search = F.struct(
        F.concat(F.lit("query "), key % 7).alias("query"),
        (key % 90).alias("result_count"),
        F.array(F.lit("price")).alias("filters"),
    )
    deal = F.struct(
        F.concat(F.lit("tx_"), key).alias("transaction_id"),
        F.lit("card").alias("payment_method"),
        (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("long").alias("total_amount"),
    )

    def parts(p: Column, s: Column, t: Column) -> tuple[Column, ...]:
        return p.alias("product"), s.alias("search"), t.alias("transaction")

    events = F.array_compact(F.array(
        F.when(searched, event(0, "search", "search_results", *parts(no_product, search, no_deal))),
        event(1, "view", "product_detail", *parts(product(viewed), no_search, no_deal)),
        F.when(carted, event(2, "add_cart", "cart", *parts(product(bagged), no_search, no_deal))),
        F.when(bought, event(3, "purchase", "checkout", *parts(product(bagged), no_search, deal))),
    ))
    total = 1 + searched.cast("int") + carted.cast("int") + bought.cast("int")
    other = (carted | bought) & (viewed != bagged)
    body = F.struct(
        F.concat(F.lit("sess_"), key).alias("session_id"),
        F.concat(F.lit("u_"), "o_custkey").alias("user_id"),
        iso(start).alias("started_at"),
        iso(F.timestamp_seconds(F.unix_seconds(start) + seconds)).alias("ended_at"),
        seconds.alias("duration_seconds"),
        total.alias("event_count"),
        F.struct(
            F.when(key % 3 == 0, "tablet").when(key % 3 == 1, "mobile").otherwise("desktop").alias("type"),
            F.concat(F.lit("os "), key % 4).alias("os"),
            F.concat(F.lit("model "), key % 5).alias("model"),
            F.lit(True).alias("is_mobile"),
        ).alias("device"),
        F.struct(
            F.lit("direct").alias("referrer"),
            F.when(key % 5 == 0, F.struct(
                F.lit("newsletter").alias("source"), F.lit("email").alias("medium"),
            )).alias("utm"),
            (key % 6 == 0).alias("is_first_visit"),
            F.struct(
                F.concat(F.lit("region "), key % 8).alias("region"),
                F.concat(F.lit("city "), key % 80).alias("city"),
            ).alias("location"),
        ).alias("context"),
        events.alias("events"),
        F.struct(
            total.alias("total_events"),
            (1 + other.cast("int")).alias("unique_products_viewed"),
            searched.cast("int").alias("searches_count"),
            F.lit(1).alias("views_count"),
            carted.cast("int").alias("add_cart_count"),
            bought.cast("int").alias("purchase_count"),
            bought.alias("converted"),
            (total == 1).alias("bounce"),
        ).alias("summary"),
    )
    return orders.select(F.to_json(body).alias("value"))


def _created(doc_id: str) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.col(doc_id) % 30).cast("int"))


def reviews(documents: DataFrame) -> DataFrame:
    """Canonical reviews; the source of a document plays the product."""
    return documents.select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("product_id"),
        (1 + F.col("doc_id") % 5).cast("int").alias("rating"),
        F.col("text").alias("review_text"),
        F.length("text").alias("text_length"),
        (F.col("doc_id") % 4 == 0).alias("has_images"),
        _created("doc_id").alias("created_date"),
    )


def review_messages(documents: DataFrame) -> DataFrame:
    number = F.col("doc_id")
    body = F.struct(
        F.concat(F.lit("rv_"), number).alias("review_id"),
        F.col("source").alias("product_id"),
        F.concat(F.lit("u_"), number % 97).alias("user_id"),
        (1 + number % 5).alias("rating"),
        "text",
        F.when(number % 4 == 0, F.array(F.lit("a.jpg"), F.lit("b.jpg")))
        .when(number % 4 == 1, F.array().cast("array<string>")).alias("images"),
        (number % 11).alias("helpful_count"),
        iso(_created("doc_id").cast("timestamp")).alias("created_at"),
        (number % 2 == 0).alias("verified_purchase"),
    )
    return documents.select(F.to_json(body).alias("value"))


def search_messages(raw: DataFrame, parts: DataFrame) -> DataFrame:
    """One search per event, for the name of its product, every tenth one misspelt."""
    named = join_dimension(
        raw.withColumn("product_id", F.get_json_object("props", "$.k").cast("long")),
        products(parts), "product_id",
    )
    number, name = F.col("event_id"), F.coalesce("product_name", F.lit(""))
    length = F.length(name)
    spelt = (
        F.when(number % 30 == 0, F.concat(name, F.right(name, F.lit(1))))
        .when(number % 30 == 10, F.concat(F.left(name, F.lit(1)), F.substring(name, F.lit(3), length)))
        .when(number % 30 == 20, F.concat(
            F.left(name, length - 2), F.right(name, F.lit(1)), F.substring(name, length - 1, F.lit(1)),
        ))
        .otherwise(name)
    )
    shape = number % 5
    query = (
        F.when(shape == 1, F.concat(F.lit("Best "), spelt))
        .when(shape == 2, F.concat(F.lit("gift for "), spelt))
        .when(shape == 3, F.concat(spelt, F.lit("  free shipping")))
        .when(shape == 4, F.concat(spelt, F.lit(" vs old rod")))
        .otherwise(spelt)
    )
    label = (
        F.when(shape == 1, "recommendation").when(shape == 2, "natural")
        .when(shape == 3, "specific").when(shape == 4, "comparison").otherwise("structured")
    )
    results = F.col("product_id") * 10
    clicked = number % 10 < 7
    body = F.struct(
        F.concat(F.lit("sq_"), number).alias("search_id"),
        F.concat(F.lit("u_"), "user_id").alias("user_id"),
        query.alias("query"),
        F.length(query).alias("query_length"),
        label.alias("pattern_type"),
        iso(F.col("ts").cast("timestamp")).alias("timestamp"),
        results.alias("result_count"),
        clicked.alias("clicked"),
        F.when(clicked & (results > 0), 1 + number % 10).alias("clicked_position"),
        F.concat(F.lit("sess_"), number % 500).alias("session_id"),
        F.when(number % 3 == 0, F.array(F.struct(
            F.lit("price").alias("type"), F.lit(10000.0).alias("min"), F.lit(50000.0).alias("max"),
        ))).alias("filters_applied"),
    )
    return named.select(F.to_json(body).alias("value"))


def turn_events(conversations: DataFrame) -> DataFrame:
    """Turns of conversations as exploded session events; the role is the event type."""
    return conversations.select(
        F.col("conv_id").alias("session_id"),
        F.col("role").alias("event_type"),
        F.length("text").alias("product_id"),
    )


TURN_ROLES = EventRoles(search="user", view="assistant", cart="tool", purchase="system")


def layout_rows(lineitem: DataFrame) -> DataFrame:
    """Line items in the shape of the layout comparison: price in whole cents."""
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.col("l_returnflag").alias("event_type"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_linestatus").alias("category"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * 100).cast("long").alias("price"),
        F.col("l_shipdate").cast("timestamp").alias("event_timestamp"),
        F.to_date(F.col("l_shipdate")).alias("event_date"),
    )
