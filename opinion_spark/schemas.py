"""Schemas of the tables the operators read and write."""

REVIEWS = (
    "review_id long, product_id string, user_id string, rating int, review_text string, "
    "review_title string, helpful_votes int, total_votes int, date timestamp"
)
SAMPLE_REVIEWS_CSV = (
    "reviewerID string, asin string, reviewerName string, helpful string, reviewText string, "
    "overall int, summary string, unixReviewTime long, reviewTime string"
)
PRIMARY_REVIEWS_CSV = (
    "Id long, ProductId string, UserId string, ProfileName string, HelpfulnessNumerator int, "
    "HelpfulnessDenominator int, Score int, Time long, Summary string, Text string"
)
SCRAPED_REVIEWS = (
    "page_id long, product_id string, user_id string, rating int, review_title string, "
    "review_text string, helpful_votes int, total_votes int, review_date date, "
    "verified_purchase boolean"
)
METRICS = (
    "event_id long, ts timestamp, component string, metric_name string, metric_value double, "
    "status string"
)
ASPECT_MAP = "map<string,struct<sentiment:double,confidence:double>>"
REQUIRED_REVIEW_COLUMNS = ["product_id", "user_id", "rating", "review_text"]
