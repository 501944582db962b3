import json

from tests.helpers import collected
from upswing.operators.subscriptions import flatten_subscriptions
from upswing.sources.documents import read_user_docs
from upswing.sources.tables import work_path
from verification import inputs


def subscription(**changes):
    return {
        "name": "mail", "yourArtists": True, "yourLabels": False,
        "primaryTerritory": {"id": "SE", "name": "Sweden"}, "secondaryTerritory": {},
        "partners": [{"name": "Spotify", "value": True}, {"name": "Apple", "value": False}],
    } | changes


def application(**changes):
    return {
        "name": "my app", "active": True, "followedArtists": [{"_id": 5}],
        "followedLabels": [{"_id": "L1", "name": "Label, with comma"}],
        "subscriptions": [subscription()],
    } | changes


def user(**changes):
    return {
        "_id": "u1", "firstName": "F", "lastName": "L", "email": "u@example.com", "active": True,
        "applications": [application()],
    } | changes


def flatten(spark, *users):
    """Through a JSON file, so that absent fields are really absent."""
    path = work_path(spark, "docs")
    spark.createDataFrame([(json.dumps(u),) for u in users], "value string").write.text(path)
    return flatten_subscriptions(read_user_docs(spark, path), "app", "mail")


def without(document, field):
    return {key: value for key, value in document.items() if key != field}


def test_gate(spark):
    users = [
        user(_id="ok"),
        without(user(_id="no name"), "firstName"),
        without(user(_id="no mail"), "email"),
        without(user(_id="unknown state"), "active"),
        user(_id="inactive", active=False),
        user(_id="no apps", applications=[]),
        without(user(_id="absent apps"), "applications"),
        user(_id="other app", applications=[application(name="something")]),
        user(_id="app off", applications=[application(active=False)]),
        user(_id="follows none", applications=[application(followedArtists=[])]),
        user(_id="other mail", applications=[application(subscriptions=[subscription(name="x")])]),
        user(
            _id="topics off",
            applications=[application(subscriptions=[subscription(yourArtists=False)])],
        ),
        user(
            _id="flag absent",
            applications=[
                application(
                    subscriptions=[without(subscription(yourLabels=True), "yourArtists")]
                )
            ],
        ),
    ]
    assert collected(flatten(spark, *users), "userId", "category") == {
        ("ok", "artist"), ("flag absent", "label"),
    }


def test_items_times_partners_and_names_with_commas(spark):
    both = subscription(
        yourLabels=True,
        primaryTerritory={"id": "SE", "name": "Sweden, all"},
        partners=[{"name": "Spotify", "value": True}, {"name": "Apple", "value": True}],
    )
    rows = flatten(spark, user(applications=[application(subscriptions=[both])]))
    assert collected(rows, "category", "artist", "label", "labelname", "partner") == {
        ("artist", 5, None, None, "Spotify"),
        ("artist", 5, None, None, "Apple"),
        ("label", None, "L1", "Label, with comma", "Spotify"),
        ("label", None, "L1", "Label, with comma", "Apple"),
    }
    assert collected(rows, "primaryTerritoryName", "secondaryTerritoryCode") == {
        ("Sweden, all", None)
    }


def test_territories_of_several_subscriptions_are_joined_and_cut_to_two(spark):
    first = subscription(secondaryTerritory={"id": "US", "name": "States"})
    second = subscription(primaryTerritory={"id": "NO", "name": "Norway"})
    rows = flatten(
        spark,
        user(_id="a", applications=[application(subscriptions=[first, second])]),
        user(_id="b", applications=[application(subscriptions=[second, first])]),
    )
    assert collected(rows, "userId", "primaryTerritoryCode", "secondaryTerritoryCode") == {
        ("a", "SE", "US"), ("b", "NO", "SE"),
    }
    # each subscription lists the artist and the partner once more
    assert rows.filter("userId = 'a'").count() == 4


def test_inactive_application_of_the_name_counts_once_the_gate_is_open(spark):
    off = application(name="old app", active=False, followedArtists=[{"_id": 9}])
    rows = flatten(spark, user(applications=[application(), off]))
    assert collected(rows, "artist") == {(5,), (9,)}


def test_customers_of_one_file_are_made_into_documents_by_several_tasks(spark, tmp_path):
    customers = spark.range(50_000).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    docs = inputs.user_docs(spark, str(tmp_path), dealt=True)
    assert docs.rdd.getNumPartitions() == 3
    assert docs.select("_id").distinct().count() == docs.count() == 50_000
