from pyspark.sql import SparkSession


def make_session(cpus: str = "8", **extra: str) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("pulsewatch")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false"))
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
