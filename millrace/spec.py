"""Which column plays which role, plus the fixed data contracts."""

from __future__ import annotations

from dataclasses import dataclass


# --- Fixed values: column roles ---------------------------------------------------------------

# Columns that a clean row must have; what makes a version of a key newer, later entries break ties.
REQUIRED = ("id", "primary_type", "district", "latitude", "longitude")
RECENCY = ("event_time", "kafka_offset", "ingestedAt")

# ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class EventSpec:
    """Binds the roles the operators need to the columns of one event table."""

    key: str = "id"
    type: str = "primary_type"
    region: str = "district"
    time: str = "event_time"
    flags: tuple[str, ...] = ("arrest", "domestic")
    coordinates: tuple[str, ...] = ("latitude", "longitude")
    required: tuple[str, ...] = REQUIRED
    recency: tuple[str, ...] = RECENCY
    count: str = "crime_count"

    @property
    def main_flag(self) -> str:
        return self.flags[0]


INCIDENTS = EventSpec()

# --- Fixed values: data contracts -------------------------------------------------------------

# Header of the delimited source file; every column arrives as text.
SOURCE_COLUMNS = (
    "ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
    "Location Description", "Arrest", "Domestic", "Beat", "District", "Ward",
    "Community Area", "FBI Code", "X Coordinate", "Y Coordinate", "Year",
    "Updated On", "Latitude", "Longitude", "Location",
)

# JSON payload of one message.
PAYLOAD_SCHEMA = (
    "id BIGINT, case_number STRING, primary_type STRING, description STRING, "
    "location_description STRING, arrest BOOLEAN, domestic BOOLEAN, beat INT, district INT, "
    "ward INT, community_area INT, fbi_code STRING, year INT, latitude DOUBLE, "
    "longitude DOUBLE, event_time_ms BIGINT, ingestedAt BIGINT"
)

# Message envelope, identical to what the Kafka source delivers.
MESSAGE_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# The envelope's columns in the raw table, by their names in a message.
RAW_ENVELOPE = {
    "key": "kafka_key", "topic": "kafka_topic", "partition": "kafka_partition",
    "offset": "kafka_offset", "timestamp": "kafka_timestamp",
}

# How a topic is read: from its start, gaps tolerated, so many messages to a micro-batch.
TOPIC_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
TOPIC_BATCH = 200_000

# Columns of the cleaned table, in order.
SILVER_COLUMNS = (
    "id", "case_number", "primary_type", "description", "location_description",
    "arrest", "domestic", "beat", "district", "ward", "community_area", "fbi_code",
    "year", "latitude", "longitude", "event_time", "event_date", "event_year",
    "hour_of_day", "day_of_week", "month", "ingestedAt",
)

# Columns of the feature snapshot, in order.
FEATURE_VIEW_COLUMNS = (
    "id", "primary_type", "hour_of_day", "day_of_week", "month", "event_year",
    "is_weekend", "is_night", "district", "ward", "community_area", "beat",
    "latitude", "longitude", "arrest_int", "domestic_int",
)

# Model inputs; the position is the index into importances and coefficients.
MODEL_FEATURES = (
    "district", "ward", "community_area", "beat", "hour_of_day", "day_of_week",
    "month", "year", "latitude", "longitude", "arrest_int", "domestic_int",
)

# Scored rows handed to consumers.
PREDICTION_COLUMNS = (
    "actual_label", "predicted_label", "district", "latitude", "longitude",
    "hour_of_day", "day_of_week",
)
