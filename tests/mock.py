"""A small shop of bicycles, lamps and flasks with answers worked out by hand."""

from pyspark.sql import functions as F

from feira.functions import collections as C, dates, geo, semistructured as J

NOW = "2025-11-20 09:00:00"


def categories(spark):
    return spark.createDataFrame(
        [(10, "Ar livre", "outdoor"), (20, "Mobilidade", "mobility"), (30, "Iluminação", "lighting")],
        "category_id int, category_name string, category_name_english string")


def products(spark):
    columns = ("product_id string, category_id int, name string, description string, spec string,"
               "photos array<string>, tags array<string>, size array<string>, price string")
    rows = [
        ("B-7", 20, "Bicicleta urbana plegable", "Cuadro de acero, ocho marchas y luz.", '{"frame": "acero", "gears": 8, "fold": true}',
         ["b/front.png", "b/side.png", "b/bag.png"], ["movilidad", "ciudad"], ["140", "95", "25", "13500"], "1290.00"),
        ("L-3", 30, "Lámpara de lectura", "Luz cálida regulable para la mesa.", '{"watt": 9, "base": "imán", "fold": "brazo"}',
         None, ["luz", "mesa", "ciudad"], ["12", "40", "12", "650"], "88.40"),
        ("T-5", 10, "Termo de montaña", "Mantiene caliente el té doce horas.", '{"litres": 1, "frame": "inox"}',
         ["t/1.png"], ["aire libre"], ["9", "31", "9", "540"], "61.25"),
    ]
    size = F.struct(*[F.col("size")[k].cast(kind).alias(name) for k, (name, kind) in enumerate((
        ("length_cm", "decimal(8,2)"), ("height_cm", "decimal(8,2)"), ("width_cm", "decimal(8,2)"), ("weight_g", "decimal(10,2)")))])
    return spark.createDataFrame(rows, columns).select(
        "product_id", "category_id", "name", "description", J.parse(F.col("spec")).alias("product_specifications"),
        F.col("photos").alias("product_photos"), F.col("tags").alias("product_tags"), size.alias("dimensions"),
        F.col("price").cast("decimal(12,2)").alias("base_price"))


def promotions(spark, now=NOW):
    """One campaign around ``now``, one in the spring of 2025."""
    at = dates.instant(now)
    rows = spark.createDataFrame([("W", "winter", "12.50", [20, 30]), ("S", "spring", "40.00", [10])],
                                 "promotion_id string, name string, pct string, target_category_ids array<int>")
    winter = F.col("promotion_id") == "W"
    lower = F.when(winter, dates.shift(at, -2, "day")).otherwise(dates.instant("2025-03-10 00:00:00"))
    upper = F.when(winter, dates.shift(at, 7, "day")).otherwise(dates.instant("2025-04-02 12:00:00"))
    return rows.select(
        "promotion_id", "name", F.col("pct").cast("decimal(5,2)").alias("discount_percentage"),
        F.lit(None).cast("decimal(12,2)").alias("discount_amount"), C.period(lower, upper).alias("promotion_period"),
        "target_category_ids", F.array().cast("array<string>").alias("target_product_ids"))


def _addressed(spark, who, rows):
    names = [f"{who}_{c}" for c in ("zip_code_prefix", "city", "state")]
    key = "customer_unique_id" if who == "customer" else "seller_id"
    df = spark.createDataFrame(rows, f"{key} string, {names[0]} int, {names[1]} string, {names[2]} string")
    return df.withColumn(f"{who}_geo", F.lit(None).cast("struct<lng:double,lat:double>"))


def placed(spark):
    """A customer in Belo Horizonte and a seller in Curitiba, with their points looked up."""
    from feira.plans.delivery import enrich_geo

    zips = spark.createDataFrame(
        [(1, 30100, -19.9167, -43.9345), (2, 80010, -25.4284, -49.2733), (3, 80010, 1.0, 1.0)],
        "geolocation_id long, geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double")
    return enrich_geo(
        _addressed(spark, "customer", [("CL-1", 30100, "Belo Horizonte", "MG")]),
        _addressed(spark, "seller", [("VD-9", 80010, "Curitiba", "PR")]), zips)


def orders(spark):
    df = spark.createDataFrame([("PED-1", "CL-1", "approved", "2025-11-18 08:30:00", "2025-11-25 18:00:00")],
                               "order_id string, customer_unique_id string, order_status string, bought string, due string")
    steps = ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")
    return df.select(
        "order_id", "customer_unique_id", "order_status", F.col("bought").cast("timestamp_ntz").alias("order_purchase_timestamp"),
        *[F.lit(None).cast("timestamp_ntz").alias(c) for c in steps],
        F.col("due").cast("timestamp_ntz").alias("order_estimated_delivery_date"))


def items(spark):
    return spark.createDataFrame([], (
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp_ntz,"
        "price decimal(12,2), freight_value decimal(12,2)"))


def reviews(spark):
    return spark.createDataFrame([("OPI-1", "product", "PED-1", "L-3", "VD-9", "CL-1", 4)], (
        "review_id string, review_type string, order_id string, product_id string, seller_id string,"
        "customer_unique_id string, score int")).withColumn("created_at", dates.instant(NOW))


def events(spark):
    """One visit: a look, the same product twice into the cart, an order."""
    kinds = ["page_view", "add_to_cart", "add_to_cart", "order_completed"]
    df = spark.createDataFrame([(k + 1, kind) for k, kind in enumerate(kinds)], "event_id long, type string")
    return df.select(
        "event_id", F.lit("visita_3").alias("session_id"), F.lit("CL-1").alias("customer_unique_id"), "type",
        F.timestamp_add("SECOND", (F.col("event_id") * 40).cast("int"), dates.instant("2025-11-18 08:20:00")).alias("ts"),
        F.lit(1.0).alias("value"), F.lit('{"k": 5}').alias("props"))


def point(lng, lat):
    return geo.point(F.lit(float(lng)), F.lit(float(lat)))
