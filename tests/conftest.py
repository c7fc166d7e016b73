import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from checks.compare import local_session  # noqa: E402
from galewatch import schemas  # noqa: E402
from galewatch.sources import messages as sources  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


def record(tweet_id, **fields):
    """A raw message; missing parts stay missing in the file."""
    return {"id": tweet_id, **fields}


FIRST = [
    record(
        1,
        created_at="Mon Aug 28 10:11:12 +0000 2017",
        geo={"coordinates": [29.76, -95.36]},
        place={"full_name": "Houston, TX"},
        aidr={"crisis_name": "storm"},
        user={"id": 11, "name": "Ann", "location": "here", "followers_count": 10, "verified": True},
        text="#Harvey: città RT @x https://t.co/Ab good shelter shelter",
        entities={"hashtags": [{"text": "Harvey"}, {"text": "Houston,Flood"}]},
    ),
    record(
        2,
        created_at="Mon Aug 28 10:59:59 +0000 2017",
        place={"full_name": "Texas"},
        user={"id": 12, "followers_count": 200, "verified": False},
        text="awful flood water",
        entities={"hashtags": [{"text": "harvey"}]},
    ),
    record(
        3,
        created_at="Tue Aug 29 10:00:00 +0000 2017",
        place={"full_name": "Baton Rouge, LA"},
        user={"id": 13, "followers_count": 30},
        text="good but awful shelter",
        entities={"hashtags": []},
    ),
    record(
        3,
        created_at="Tue Aug 29 10:00:00 +0000 2017",
        place={"full_name": "Baton Rouge, LA"},
        user={"id": 13, "followers_count": 30},
        text="good but awful shelter",
        entities={"hashtags": []},
    ),
    record(4, created_at="Mon Feb 29 23:00:00 +0000 2016", place={"full_name": "  "}, user={"verified": True}, text=""),
    record(5, created_at="", place={"full_name": "Austin,TX"}, user={"id": 15, "followers_count": 7}),
    record(6, text="water", user={"id": 16, "followers_count": 1, "verified": False}),
]

# Other key set and order, and no position in any record.
SECOND = [
    {"text": "shelter for the GOOD", "id": 7, "geo": None, "created_at": "Wed Aug 30 00:30:00 +0000 2017"},
    {"id": 8, "user": {"followers_count": 5, "id": 18}, "created_at": "Thu Feb 30 12:00:00 +0000 2017", "geo": None},
]

# id, label, confidence; every label of the domain, ids without message or not numbers, unreadable confidences.
LABELS = [
    ("1", "donation_and_volunteering", "0.9"),
    ("2", "infrastructure_and_utilities_damage", "0.8"),
    ("3", "donation_and_volunteering", "0.7"),
    ("4", "personal", "n/a"),
    ("5", "personal", ""),
    ("6", None, "0.5"),
    ("7", "displaced_and_evacuations", "0.6"),
    ("8", "displaced_and_evacuations", "0.4"),
    ("abc", "personal", "0.5"),
    *[(str(900 + i), label, "0.5") for i, label in enumerate(schemas.LABELS)],
]


@pytest.fixture(scope="session")
def message_dirs(tmp_path_factory):
    first, second = tmp_path_factory.mktemp("first"), tmp_path_factory.mktemp("second")
    lines = [json.dumps(item) for item in FIRST]
    (first / "a.json").write_text("\n".join([*lines[:3], "not json", *lines[3:]]) + "\n")
    (first / "notes.txt").write_text("not a message file\n")
    (second / "b.json").write_text("\n".join(json.dumps(item) for item in SECOND) + "\n")
    return str(first), str(second)


@pytest.fixture(scope="session")
def label_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("labels") / "labels.txt"
    rows = ["\t".join([i, "2017-08-28", label or "", confidence]) for i, label, confidence in LABELS]
    path.write_text("\n".join(["TweetID\tDate\tAIDRLabel\tAIDRConfidence", *rows]) + "\n")
    return str(path)


@pytest.fixture(scope="session")
def flat(spark, message_dirs):
    return sources.read_messages(spark, *message_dirs).cache()


@pytest.fixture(scope="session")
def labels(spark, label_file):
    return sources.read_labels(spark, label_file)


@pytest.fixture(scope="session")
def labelled(flat, labels):
    return sources.join_labels(flat, labels).cache()
