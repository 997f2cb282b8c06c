from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("tests")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.sql.maxMetadataStringLength", "2000").config("spark.driver.memory", "8g")
             .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
