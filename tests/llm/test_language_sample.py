"""Every language seen in training is learned, and repeated ids do not widen the fitting sample."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.llm import language

RARE = ["kaikki ihmiset syntyvät vapaina ja tasavertaisina", "heille on annettu järki ja omatunto", "heidän on toimittava toisiaan kohtaan veljeyden hengessä"]


def test_rare_language_and_repeated_ids():
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    common = spark.range(6000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("this is the story of the house and the road").alias("text"), F.lit("en").alias("lang"))
    others = spark.range(6000).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("und das ist der Weg "), F.col("id").cast("string")).alias("text"), F.lit("de").alias("lang"))
    rare = spark.createDataFrame([(7_000_000 + i, t, "fi") for i, t in enumerate(RARE * 4)], "doc_id long, text string, lang string")
    docs = common.union(others).union(rare)
    assert set(language.fit(docs, 100)[0]) == {"de", "en", "fi"}
    train = docs.filter(language.crc_mod("doc_id", 3) != 1)
    took = {r["lang"]: r["count"] for r in language.chosen(train, 120).groupBy("lang").count().collect()}
    assert took["en"] == 1 and took["de"] == 40 and took["fi"] == train.filter("lang = 'fi'").count()
