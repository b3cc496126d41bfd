"""The input tables of the jobs, derived from a generic event log and a sales schema.

Event types stand for actions: view = search, click = click, purchase = order, signup = payment,
error = plain page visit.
"""

from pyspark.sql import functions as F

# Schemas read from the files once, so that later reads need no job to infer them; files that change are read anew.
_SCHEMAS = {}


class EventTables:
    """Input tables over a folder of Parquet files; each property is a fresh lazy frame."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = folder

    def raw(self, name):
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, self.version(name))
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(path)

    def version(self, *names):
        """What tells the files of tables from other ones at the same place: paths, lengths and times of change."""
        found = []
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
            files = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
            found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
        return tuple(sorted(found))

    def _events(self):
        return self.raw("events").select(
            "event_id",
            "ts",
            "user_id",
            "event_type",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.col("ts").cast("date").cast("string").alias("day"),
        )

    def _actions(self, *extra, kind=None):
        k, user = F.col("k"), F.col("user_id")

        def when(kind, value):
            return F.when(F.col("event_type") == kind, value)

        def text(c):
            return c.cast("string")

        events = self._events()
        if kind:
            events = events.filter(F.col("event_type") == kind)
        return events.select(
            *extra,
            F.col("day").alias("date"),
            "user_id",
            F.concat(text(user), F.lit("_"), F.col("day")).alias("session_id"),
            (k % 10).alias("page_id"),
            F.col("ts").alias("action_time"),
            when("view", F.concat(F.lit("kw"), text(k % 12))).alias("search_keyword"),
            when("click", k % 20).alias("click_category_id"),
            when("click", k).alias("click_product_id"),
            when("purchase", F.concat(text(k % 20), F.lit(","), text((k + 7) % 20))).alias("order_category_ids"),
            when("purchase", text(k)).alias("order_product_ids"),
            when("signup", text((k + 3) % 20)).alias("pay_category_ids"),
            when("signup", text(k)).alias("pay_product_ids"),
            (user % 27).alias("city_id"),
        )

    @property
    def actions(self):
        return self._actions()

    @property
    def click_actions(self):
        """The clicks alone; the test reaches the file scan."""
        return self._actions(kind="click")

    @property
    def numbered_actions(self):
        """Actions with ``seq``, their position in the log."""
        return self._actions(F.col("event_id").alias("seq"))

    @property
    def users(self):
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("user_id"),
            F.col("c_name").alias("username"),
            F.col("c_name").alias("name"),
            (F.floor(F.abs("c_acctbal")).cast("int") % 60).alias("age"),
            F.col("c_mktsegment").alias("professional"),
            F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
            F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
        )

    @property
    def products(self):
        size = F.col("p_size")
        info = F.concat(F.lit('{"product_status": '), (size % 2).cast("string"), F.lit("}"))
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.when(size % 5 != 0, info).alias("extend_info"),
        )

    @property
    def cities(self):
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").cast("bigint").alias("city_id"),
            F.col("n_name").alias("city_name"),
            F.col("r_name").alias("area"),
        )

    def ad_log(self, *extra):
        """The ad-click log as text lines; ``extra`` columns over the event log come first."""
        lines = self._events().join(
            self.cities.select(
                F.replace("area", F.lit(" "), F.lit("-")).alias("province"),
                F.replace("city_name", F.lit("_"), F.lit("-")).alias("city"),
                F.col("city_id").alias("_city"),
            ),
            F.col("user_id") % 25 == F.col("_city"),
        )
        value = F.concat_ws(
            " ",
            F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
            "province",
            "city",
            F.col("user_id").cast("string"),
            (F.col("k") % 5).cast("string"),
        )
        return lines.select(*extra, value.alias("value"))

    @property
    def sales_clicks(self):
        """Line items as clicks: the ordering customer's nation is the city, the part is the product."""
        items = self.raw("lineitem").select("l_orderkey", "l_partkey")
        orders = self.raw("orders").select("o_orderkey", "o_custkey")
        customers = self.raw("customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("city_id"))
        placed = orders.join(customers, orders.o_custkey == customers.c_custkey).select("o_orderkey", "city_id")
        return items.join(placed, items.l_orderkey == placed.o_orderkey).select(
            "city_id", F.col("l_partkey").alias("product_id")
        )
