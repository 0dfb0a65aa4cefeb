"""The tables of a data folder, read as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Column types of the marketplace tables, as delivered.
SCHEMAS = {
    "fact_user_events": "is_login string, user_id string, session_id string, event_id string, item_id string, city_name string, category bigint, event_type string, query string, event_ts timestamp_ntz, surface string, position bigint, device string, dwell_time_sec bigint, is_contact bigint, date date",
    "fact_post_contact_interactions": "user_id string, item_id string, date date, adview_count bigint, lead_count bigint, chat_message_count bigint, chat_turn_count bigint, chat_lead bigint, purchased boolean, category bigint",
    "fact_listing_snapshot": "snapshot_id bigint, item_id string, date date, views_24h bigint, contacts_24h bigint, listing_age_days bigint, loaded_at timestamp_ntz",
    "contact_pairs": "user_id string, item_id string, city_name string, category bigint, count bigint, last_date date",
    "dim_listing": "item_id string, seller_id string, category bigint, title string, seller_type string, ad_type string, ad_status string, area_sqm double, bedrooms bigint, bathrooms bigint, floors bigint, width_m double, direction string, legal_status string, house_type string, furnishing string, city_name string, district_name string, ward_name string, project_id string, price_bucket string, images_count bigint, posted_date date, expected_expired_date date",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, seller_id string, item_id string, posted_date date",
    "eval_items": "eval_id bigint, text string, lang string, task string",
    "source_weights": "source string, target_share double, max_repeats bigint",
}


class Tables:
    """Each table of the folder; the declared schema spares Spark a footer read."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def events(self) -> DataFrame:
        return self["fact_user_events"]

    @property
    def pci(self) -> DataFrame:
        return self["fact_post_contact_interactions"]

    @property
    def snapshots(self) -> DataFrame:
        return self["fact_listing_snapshot"]

    @property
    def contact_pairs(self) -> DataFrame:
        return self["contact_pairs"]

    @property
    def listings(self) -> DataFrame:
        return self["dim_listing"]

    @property
    def documents(self) -> DataFrame:
        return self["documents"]

    @property
    def eval_items(self) -> DataFrame:
        return self["eval_items"]

    @property
    def source_weights(self) -> DataFrame:
        return self["source_weights"]
