"""Reading feature tables, admin polygons and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAGS_TYPE = "map<string,string>"
RELEASE = r"(\d{4}-\d{2}-\d{2})\.(\d+)"


def scan_release(spark: SparkSession, root: str, release: str, theme: str, feature_type: str) -> DataFrame:
    """One theme and type of a hive-partitioned release, with a ``filename`` column.

    Only that directory is listed, and its own files give the schema: types of one
    release differ in their columns."""
    base = f"{root.rstrip('/')}/{release}"
    df = spark.read.option("basePath", base).parquet(f"{base}/theme={theme}/type={feature_type}")
    return df.withColumn("filename", F.col("_metadata.file_path"))


def scan_extract(spark: SparkSession, *paths: str) -> DataFrame:
    """A cached extract; an empty one may lack ``tags``, which is then NULL."""
    return ensure_tags(spark.read.parquet(*paths))


def ensure_tags(df: DataFrame) -> DataFrame:
    if has_column(df, "tags"):
        return df
    return df.withColumn("tags", F.lit(None).cast(TAGS_TYPE))


def has_column(df: DataFrame, name: str) -> bool:
    """Looks at the schema only; no job is run."""
    return name in df.columns


def admin_level(df: DataFrame, level: int, iso3: str, geom: str = "geom") -> DataFrame:
    """``(pcode, name, adm0_pcode, adm0_name, geom)`` of one country's polygons."""
    return df.where(F.col("iso_3") == F.lit(iso3.upper())).select(
        F.col(f"adm{level}_src").alias("pcode"),
        F.col(f"adm{level}_name").alias("name"),
        F.col("adm0_src").alias("adm0_pcode"),
        F.col("adm0_name").alias("adm0_name"),
        F.col(geom).alias("geom"),
    )


def scan_admin(spark: SparkSession, path: str, level: int, iso3: str) -> DataFrame:
    return admin_level(spark.read.parquet(path), level, iso3)


def latest_release(listing: DataFrame, requested: str = "latest", column: str = "prefix") -> DataFrame:
    """One row ``release``: the requested one as it is, else the newest
    ``YYYY-MM-DD.N`` of the listing, N compared as a number. None at all raises."""
    if requested and requested != "latest":
        return listing.sparkSession.createDataFrame([(requested,)], "release string")
    day, n = F.regexp_extract(column, RELEASE, 1), F.regexp_extract(column, RELEASE, 2)
    found = listing.where(F.col(column).rlike(RELEASE)).select(
        F.struct(day.alias("day"), n.cast("int").alias("n"), F.concat_ws(".", day, n).alias("release")).alias("r")
    )
    best = F.max("r")["release"]
    return found.agg(
        F.coalesce(best, F.raise_error(F.lit("no release found in the listing")).cast("string")).alias("release")
    )


def latest_snapshot(listing: DataFrame, requested: str = "latest", column: str = "name") -> DataFrame:
    """One row ``snapshot``: the requested directory if it exists, else the greatest
    name. Nothing to choose from raises."""
    rows = listing
    if requested and requested != "latest":
        rows = listing.where(F.col(column) == requested)
    problem = F.raise_error(F.lit(f"no snapshot {requested!r} in the listing")).cast("string")
    return rows.agg(F.coalesce(F.max(column), problem).alias("snapshot"))


def lookup_extract(index: DataFrame, countries: DataFrame, continents: list[str]) -> DataFrame:
    """Best regional extract per country. ``index``: (id, name, parent, codes, url);
    ``countries``: (iso3, iso2). A candidate lists the country's code and lies right
    under a continent or has no parent; one that lists only that code comes first,
    then the smaller id."""
    direct = index.where(F.col("parent").isNull() | F.col("parent").isin(*continents))
    listed = direct.withColumn("iso2", F.explode(F.array_distinct("codes"))).join(countries, "iso2")
    choice = F.struct((F.col("codes") != F.array("iso2")).alias("shared"), "id", "name", "url")
    return (
        listed.groupBy("iso3", "iso2").agg(F.min(choice).alias("c"))
        .select(
            F.upper("iso3").alias("iso3"), "iso2", F.col("c.id").alias("extract_id"), F.col("c.name").alias("name"),
            F.col("c.url").alias("pbf_url"), F.concat("c.url", F.lit(".md5")).alias("md5_url"),
        )
    )


# Parents under which country extracts sit directly.
CONTINENTS = [
    "africa", "antarctica", "asia", "australia-oceania", "central-america", "europe", "north-america",
    "russia", "south-america",
]

MAX_LOCAL_LANGUAGES = 3


def local_languages(countries: DataFrame, dimension: DataFrame) -> DataFrame:
    """``(iso3, languages)``: up to three official languages other than English, in
    rank order; empty for an unknown country. ``dimension``: (iso3, rank, lang)."""
    official = (
        dimension.where("lang <> 'en'")
        .groupBy(F.upper("iso3").alias("_iso3"), "lang").agg(F.min("rank").alias("rank"))
        .groupBy("_iso3")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "lang"))).alias("l"))
        .select("_iso3", F.slice(F.transform("l", lambda e: e["lang"]), 1, MAX_LOCAL_LANGUAGES).alias("l"))
    )
    return countries.join(official, F.upper("iso3") == F.col("_iso3"), "left").select(
        *countries.columns, F.coalesce("l", F.array().cast("array<string>")).alias("languages")
    )


# Official languages by country, most used first. A country that is not
# listed has to be given in a table of the same shape (``local_languages``).
COUNTRY_LANGUAGES = {
    "AFG": "ps fa", "AGO": "pt", "ALB": "sq", "AND": "ca", "ARE": "ar", "ARG": "es", "ARM": "hy", "AUS": "en",
    "AUT": "de", "AZE": "az", "BDI": "rn fr en", "BEL": "nl fr de", "BEN": "fr", "BFA": "fr", "BGD": "bn",
    "BGR": "bg", "BHR": "ar", "BIH": "bs hr sr", "BLR": "be ru", "BLZ": "en", "BOL": "es qu ay", "BRA": "pt",
    "BRN": "ms", "BTN": "dz", "BWA": "en tn", "CAF": "fr sg", "CAN": "en fr", "CHE": "de fr it rm", "CHL": "es",
    "CHN": "zh", "CIV": "fr", "CMR": "fr en", "COD": "fr", "COG": "fr", "COL": "es", "COM": "ar fr", "CPV": "pt",
    "CRI": "es", "CUB": "es", "CYP": "el tr", "CZE": "cs", "DEU": "de", "DJI": "ar fr", "DNK": "da", "DOM": "es",
    "DZA": "ar fr", "ECU": "es qu", "EGY": "ar", "ERI": "ti ar en", "ESP": "es", "EST": "et", "ETH": "am",
    "FIN": "fi sv", "FJI": "en fj hif", "FRA": "fr", "GAB": "fr", "GBR": "en", "GEO": "ka", "GHA": "en", "GIN": "fr",
    "GMB": "en", "GNB": "pt", "GNQ": "es fr pt", "GRC": "el", "GTM": "es", "GUY": "en", "HND": "es", "HRV": "hr",
    "HTI": "fr ht", "HUN": "hu", "IDN": "id", "IND": "hi en", "IRL": "en ga", "IRN": "fa", "IRQ": "ar ku",
    "ISL": "is", "ISR": "he ar", "ITA": "it", "JAM": "en", "JOR": "ar", "JPN": "ja", "KAZ": "kk ru", "KEN": "sw en",
    "KGZ": "ky ru", "KHM": "km", "KIR": "en", "KOR": "ko", "KWT": "ar", "LAO": "lo", "LBN": "ar", "LBR": "en",
    "LBY": "ar", "LIE": "de", "LKA": "si ta", "LSO": "st en", "LTU": "lt", "LUX": "lb fr de", "LVA": "lv",
    "MAR": "ar fr", "MCO": "fr", "MDA": "ro", "MDG": "mg fr", "MDV": "dv", "MEX": "es", "MKD": "mk sq", "MLI": "fr",
    "MLT": "mt en", "MMR": "my", "MNE": "sr", "MNG": "mn", "MOZ": "pt", "MRT": "ar", "MUS": "en fr", "MWI": "en ny",
    "MYS": "ms", "NAM": "en", "NER": "fr", "NGA": "en", "NIC": "es", "NLD": "nl", "NOR": "nb nn", "NPL": "ne",
    "NZL": "en mi", "OMN": "ar", "PAK": "ur en", "PAN": "es", "PER": "es qu", "PHL": "en fil", "PNG": "en tpi ho",
    "POL": "pl", "PRK": "ko", "PRT": "pt", "PRY": "gn es", "PSE": "ar", "QAT": "ar", "ROU": "ro", "RUS": "ru",
    "RWA": "rw fr en", "SAU": "ar", "SDN": "ar en", "SEN": "fr", "SGP": "en ms zh ta", "SLB": "en", "SLE": "en",
    "SLV": "es", "SMR": "it", "SOM": "so ar", "SRB": "sr", "SSD": "en", "STP": "pt", "SUR": "nl", "SVK": "sk",
    "SVN": "sl", "SWE": "sv", "SWZ": "ss en", "SYC": "fr en", "SYR": "ar fr", "TCD": "fr ar", "TGO": "fr",
    "THA": "th", "TJK": "tg ru", "TKM": "tk", "TLS": "pt tet", "TON": "to en", "TUN": "ar fr", "TUR": "tr",
    "TWN": "zh", "TZA": "sw en", "UGA": "sw en", "UKR": "uk", "URY": "es", "USA": "en", "UZB": "uz", "VEN": "es",
    "VNM": "vi", "VUT": "bi en fr", "WSM": "sm en", "YEM": "ar", "ZAF": "en zu xh", "ZMB": "en", "ZWE": "en sn nd",
}


def country_languages(spark: SparkSession) -> DataFrame:
    rows = [(iso3, i, lang) for iso3, langs in COUNTRY_LANGUAGES.items() for i, lang in enumerate(langs.split())]
    return spark.createDataFrame(rows, "iso3 string, rank int, lang string")


def languages_of(iso3: str) -> list[str]:
    langs = [x for x in COUNTRY_LANGUAGES.get((iso3 or "").upper(), "").split() if x != "en"]
    return langs[:MAX_LOCAL_LANGUAGES]
