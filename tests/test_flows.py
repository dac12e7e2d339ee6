"""The whole path on a small export: files, cleaning, features, models, scores."""

import datetime as dt
import gzip
import random

import pytest
from hearthrate.functions.wording import AMENITY_PATTERNS, DESCRIPTION_PATTERNS
from hearthrate.operators import clean, quality
from hearthrate.operators.panel import PANEL_COLUMNS
from hearthrate.operators.recency import REVIEW_COLUMNS
from hearthrate.operators.scoring import score_listings
from hearthrate.plans import flows
from hearthrate.sources import artifacts, tables

LISTINGS = 240


@pytest.fixture(scope="module")
def export(spark, tmp_path_factory):
    """Text files as a listing site would export them."""
    source = random.Random(9)
    folder = tmp_path_factory.mktemp("export")
    areas = {"North": "Hills", "South": "Hills", "Harbour": "Centre"}
    rows = []
    for i in range(1, LISTINGS + 1):
        size = source.randint(1, 6)
        price = 40 + 35 * size + source.randint(0, 40)
        rows.append((
            i, f"${price:,}.00" if i % 40 else None, None, '["Wifi", "Hot tub"]' if i % 2 else '["Wifi"]',
            f'A "cozy" flat with view,\nroom {i}' if i % 3 else None, "2015-03-01", "2024-06-01",
            "2024-05-20" if i % 5 else None, "t" if i % 4 else "f", "t", "t", "f", "t",
            "95%" if i % 6 else None, "80%", f"Host {i}" if i % 30 else None, "within an hour" if i % 7 else None,
            float(size), float(size // 2 + 1), float(size) if i % 9 else None, 1.0 + size % 3, f"{size % 3} baths" if i % 11 else None,
            "Entire home" if i % 3 else "Private room", f"Type {i % 14}", 47.5 + i / 1000, -122.3 - i / 2000,
            source.choice(sorted(areas)), 200, i % 13, i % 3, 4.0 + (i % 10) / 10 if i % 5 else None, 1.5 if i % 5 else None,
        ))
    schema = (
        "id int, price string, calendar_updated string, amenities string, description string, host_since string, last_scraped string, "
        "last_review string, host_is_superhost string, instant_bookable string, host_has_profile_pic string, host_identity_verified string, "
        "has_availability string, host_response_rate string, host_acceptance_rate string, host_name string, host_response_time string, "
        "accommodates double, bedrooms double, beds double, bathrooms double, bathrooms_text string, room_type string, property_type string, "
        "latitude double, longitude double, neighbourhood_cleansed string, availability_365 int, number_of_reviews int, "
        "number_of_reviews_l30d int, review_scores_rating double, reviews_per_month double"
    )
    tables.write_delimited(spark.createDataFrame(rows, schema), str(folder / "listings"))
    (folder / "areas.csv").write_text("neighbourhood_group,neighbourhood\n" + "".join(f"{g},{n}\n" for n, g in areas.items()))
    start = dt.date(2024, 1, 1)
    with gzip.open(folder / "calendar.csv.gz", "wt") as file:
        file.write("listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n")
        for i in range(1, LISTINGS - 20):
            for d in range(0, 240, 8):
                file.write(f"{i},{start + dt.timedelta(days=d)},{source.choice('tf')},,,{1 + (d + i) % 3},30\n")
    with gzip.open(folder / "reviews.csv.gz", "wt") as file:
        file.write("listing_id,id,date,reviewer_id,reviewer_name,comments\n")
        for n in range(1500):
            text = source.choice(['"Very clean, ""lovely"" view"', '"Not clean\nand noisy"', "", "great place"])
            file.write(f"{1 + n % (LISTINGS - 10)},{n},{start - dt.timedelta(days=n % 700)},1,x,{text}\n")
    return folder, schema


@pytest.fixture(scope="module")
def features(spark, export):
    folder, schema = export
    raw = tables.read_delimited(spark, str(folder / "listings"), schema)
    cleaned = clean.clean_listings(raw).table
    lexicon = spark.createDataFrame([("clean", 2.0), ("great", 3.0), ("noisy", -1.5)], "word string, valence double")
    built = flows.feature_table(
        cleaned, tables.read_dimension(spark, str(folder / "areas.csv")), tables.read_calendar(spark, str(folder / "calendar.csv.gz")),
        tables.read_reviews(spark, str(folder / "reviews.csv.gz")), lexicon,
    )
    return built, built.table.persist()


def test_raw_text_survives(spark, export):
    folder, schema = export
    raw = tables.read_delimited(spark, str(folder / "listings"), schema)
    assert raw.count() == LISTINGS
    assert raw.where("id = 1").first()["description"] == 'A "cozy" flat with view,\nroom 1'
    assert tables.read_reviews(spark, str(folder / "reviews.csv.gz")).where("comments like '%noisy%'").first()["comments"] == "Not clean\nand noisy"


def test_feature_table(features):
    built, table = features
    frame = table.toPandas()
    expected = [i for i in range(1, LISTINGS + 1) if i % 40 and i % 30]
    assert sorted(frame["id"]) == expected
    assert not frame.columns[frame.isna().all()].tolist()
    assert (frame["distance_to_downtown"] > 0).all()
    assert frame["price"].min() >= 15
    assert "peak_demand_score" not in frame and "description" not in frame
    numbers = {*DESCRIPTION_PATTERNS, *AMENITY_PATTERNS, *PANEL_COLUMNS, *REVIEW_COLUMNS}
    dropped = set(built.selection.dropped)
    assert numbers - dropped - {"peak_demand_score", "estimated_annual_revenue"} <= set(frame.columns)
    assert frame["bathrooms_text"].notna().all()


def test_gate_on_cleaned_listings(spark, export):
    folder, schema = export
    cleaned = clean.clean_listings(tables.read_delimited(spark, str(folder / "listings"), schema)).table
    assert {r["check"] for r in quality.strict_gate(cleaned).collect()} == {"too_few_rows"}


def test_models_and_scores(spark, features, tmp_path):
    _, table = features
    data = flows.training_set(table)
    assert "id" not in data.design.features and "price" not in data.design.features
    assert data.train.count() + data.test.count() == table.where("price <= 500").count()
    trained, comparison = flows.compare_models(
        data, cross_validated=False, tree_settings={"forest": {"numTrees": 5, "maxDepth": 5}, "boosted": {"maxIter": 5, "maxDepth": 3}})
    assert {t.name for t in trained} == {"linear", "ridge", "forest", "boosted"}
    assert comparison.where("best = 1").count() == 1
    best = next(t for t in trained if t.name == comparison.first()["model"])
    assert best.metrics["test_mae"] < 60

    path = str(tmp_path / "artifact")
    artifacts.save_artifact(spark, path, best.model, data.design, price_cap=500)
    model, design, metadata = artifacts.load_artifact(spark, path)
    assert metadata == {"price_cap": 500}
    assert design == data.design
    scored = score_listings(table, design, model)
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    frame = scored.toPandas()
    assert frame["predicted_price"].between(15, 500).all()
    assert set(frame["confidence_tier"]) <= {"HIGH", "MEDIUM", "LOW"}
    one = score_listings(table.limit(1), design, model).first()
    assert one["predicted_price"] == frame.set_index("id").loc[one["id"], "predicted_price"]
    unpriced = score_listings(table.drop("price", "number_of_reviews", "days_since_last_review"), design, model)
    assert {r[0] for r in unpriced.select("confidence_tier").distinct().collect()} == {"LOW"}
