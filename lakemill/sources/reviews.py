"""Product reviews: clean-up, rules and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.rules import WARNING, Rule, in_range, required, rule
from lakemill.functions.text import folded, yes_no

# Markers of spam and of markup or SQL in a review text.
SPAM = r"(?i)(click here|buy now|free gift|hot deal|www\.)"
MARKUP = r"(?i)(<\s*script|drop\s+table)"


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Typed columns: rating and votes to nullable integers, flags to nullable booleans."""

    def whole(name: str) -> Column:
        return F.col(name).try_cast("double").try_cast("bigint")

    return reviews.withColumns(
        {
            "rating": whole("rating"),
            "helpful_votes": whole("helpful_votes"),
            "total_votes": whole("total_votes"),
            "verified_purchase": yes_no(F.col("verified_purchase").cast("string")),
            "review_length": F.coalesce(F.length("review_text"), F.lit(0)),
            "review_status": F.nullif(folded(F.col("review_status")), F.lit("")),
        }
    )


def review_rules() -> list[Rule]:
    text = F.col("review_text")
    return [
        required("review_id"),
        required("product_id"),
        in_range("rating", 1, 5, "RATING_OUT_OF_RANGE"),
        rule("SUSPECTED_SPAM:review_text", text.rlike(SPAM), WARNING),
        rule("MARKUP_IN_TEXT:review_text", text.rlike(MARKUP), WARNING),
    ]


def repeated_reviews(reviews: DataFrame) -> DataFrame:
    """Review ids that occur more than once, with their number."""
    counted = reviews.groupBy("review_id").agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def distribution(reviews: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, by value; nulls are left out."""
    counted = reviews.filter(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias("reviews")).orderBy(column)


def write_reviews(reviews: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet with snappy, or CSV with a header."""
    options = {"parquet": {"compression": "snappy"}, "csv": {"header": "true"}}[fmt]
    reviews.write.mode("overwrite").format(fmt).options(**options).save(path)
