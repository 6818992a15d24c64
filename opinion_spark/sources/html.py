"""Tables from stored HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.functions import text as X
from opinion_spark.schemas import SCRAPED_REVIEWS

FIELDS = ["user_text", "star_class", "title_text", "body_text", "votes_text", "date_text", "verified"]


class ReviewMarkup(HTMLParser):
    """Collects the raw field texts of each review container of one page.

    Only ``div`` tags are counted, so other tags may stay open. A container inside
    another one is a row of its own, and its fields count for both where the outer
    one has none yet. Containers open at the end of the page are rows too.
    """

    def __init__(self, by_class: bool = False):
        super().__init__(convert_charrefs=True)
        self.by_class, self.rows = by_class, []
        self.divs, self.open, self.captures = 0, [], []

    def handle_starttag(self, tag: str, attrs) -> None:
        a = {k: v or "" for k, v in attrs}
        hook, classes = a.get("data-hook", ""), a.get("class", "")
        if tag == "div":
            self.divs += 1
            if "review" in classes.lower() if self.by_class else hook == "review":
                self.rows.append(dict.fromkeys(FIELDS))
                self.open.append((self.divs, self.rows[-1]))
        for c in self.captures:
            c["level"] += c["tag"] == tag
        names, field = classes.split(), None
        if tag == "span" and "a-profile-name" in names or tag == "a" and "a-profile" in names:
            field = "user_text"
        elif hook == "review-title" and tag in ("a", "span"):
            field = "title_text"
        elif hook == "review-body" and tag == "span":
            field = "body_text"
        elif hook == "helpful-vote-statement" and tag == "span":
            field = "votes_text"
        elif hook == "review-date" and tag == "span":
            field = "date_text"
        for _, row in self.open:
            if field and row[field] is None:
                row[field] = ""
                self.captures.append({"row": row, "field": field, "tag": tag, "level": 1})
            if tag == "i" and "a-icon-star" in classes and row["star_class"] is None:
                row["star_class"] = classes
            if tag == "span" and hook == "avp-badge":
                row["verified"] = "yes"

    def handle_endtag(self, tag: str) -> None:
        for c in self.captures:
            c["level"] -= c["tag"] == tag
        self.captures = [c for c in self.captures if c["level"]]
        if tag == "div" and self.divs:
            while self.open and self.open[-1][0] >= self.divs:
                _, row = self.open.pop()
                self.captures = [c for c in self.captures if c["row"] is not row]
            self.divs -= 1

    def handle_data(self, data: str) -> None:
        for c in self.captures:
            c["row"][c["field"]] += data.strip()


def _containers(page: str) -> list[dict]:
    for by_class in (False, True):  # the class is the fallback
        markup = ReviewMarkup(by_class)
        markup.feed(page)
        markup.close()
        if markup.rows:
            return markup.rows
    return []


def extract_reviews(pages: DataFrame, as_of: str, user_id_length: int | None = None) -> DataFrame:
    """One row per review container of (page_id, product_id, html); user ids are cut only on request.

    Python only finds the markup; all text rules are native columns.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                {"page_id": i, "product_id": p, "place": n, **row}
                for i, p, page in zip(batch["page_id"], batch["product_id"], batch["html"])
                for n, row in enumerate(_containers(page or ""))]
            yield pd.DataFrame(rows, columns=["page_id", "product_id", "place", *FIELDS])

    raw = pages.select("page_id", F.col("product_id").cast("string"), "html").mapInPandas(
        run, "page_id long, product_id string, place int, " + ", ".join(f"{f} string" for f in FIELDS))
    body = X.strip(F.regexp_replace(F.coalesce("body_text", F.lit("")), r"(?i)Read more.*$", ""))
    votes = X.helpful_votes(F.coalesce("votes_text", F.lit("")))
    star = F.regexp_extract("star_class", r"a-star-(\d+)", 1).try_cast("int")
    anonymous = F.concat(F.lit("user_"), F.col("page_id").cast("string"), F.lit("_"), F.col("place").cast("string"))
    return raw.select(
        "page_id", "product_id", X.safe_user_id(F.coalesce("user_text", anonymous), user_id_length).alias("user_id"),
        F.coalesce(star, F.lit(3)).alias("rating"),
        X.clean_title(F.coalesce("title_text", F.lit("No Title"))).alias("review_title"), body.alias("review_text"),
        votes.alias("helpful_votes"), votes.alias("total_votes"),
        F.coalesce(X.scraped_date(F.col("date_text")), F.lit(as_of).cast("date")).alias("review_date"),
        F.col("verified").isNotNull().alias("verified_purchase"),
    ).where(F.length("review_text") >= 10).to(_schema())


def _schema():
    from pyspark.sql.types import StructType
    return StructType.fromDDL(SCRAPED_REVIEWS)


def page_fields(pages: DataFrame) -> DataFrame:
    """Title, visible text and number of paragraphs of each page."""
    html = F.col("html")
    hidden = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->", " ")
    visible = X.strip(F.regexp_replace(F.regexp_replace(hidden, r"(?s)<[^>]*>", " "), r"\s+", " "))
    return pages.select(
        "page_id", F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"),
        visible.alias("visible_text"), X.matches(html, r"(?i)<p[ >]").alias("paragraphs"))


def review_urls(products: DataFrame, base: str, reviews: Column | None = None, per_page: int = 10,
                max_pages: int | None = None) -> DataFrame:
    """(product_id, page, url) for each review page of a product, up to ``max_pages`` if that is given.

    Without the number of reviews, each product has ``max_pages`` pages (one if that is not given).
    """
    if reviews is None:
        need = F.lit(max_pages or 1)
    else:
        need = F.greatest(F.lit(1), F.ceil(reviews / per_page)).cast("int")
        need = need if max_pages is None else F.least(F.lit(max_pages), need)
    return products.select("product_id", F.explode(F.sequence(F.lit(1), need)).alias("page")).withColumn(
        "url", F.concat(F.lit(base), F.lit("/product-reviews/"), F.col("product_id").cast("string"),
                        F.lit("?pageNumber="), F.col("page").cast("string")))


