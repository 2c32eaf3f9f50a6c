from __future__ import annotations

import ast
import os
import subprocess
import sys
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storelens.functions.columns import first_of_first
from storelens.functions.nested import RELATED_LISTS, read_nested_list, read_related, related_ids

ROOT = Path(__file__).resolve().parent.parent
ENVIRONMENT = {name: value for name, value in os.environ.items() if name != "PYTHONPATH" and "SPARK" not in name}

CATEGORIES = {
    """[['Books', "Children's Books"]]""": "Books",
    "[['']]": None,
    "[]": None,
    "[[]]": None,
    "[[None]]": None,
    "bad": None,
    r"""[['it\'s "x"']]""": """it's "x\"""",
    r"[['caf\xe9']]": "caf\xe9",
    "['flat']": None,
    "(['t'],)": None,
    "[[1]]": "1",
    "[[u'x']]": "x",
    "[['a',], 'x']": "a",
    "[['a' 'b']]": "ab",
    "[['a']] junk": None,
    "[['a']] [['b']]": None,
    "[['a]] b', 'c']]": "a]] b",
    "[[true]]": None,
    "[['None', 'x']]": "None",
    "[ ['a'] ]": "a",
    "[['a'] ] junk": None,
    "[] junk": None,
    " [['a']] ": "a",
    "{'a': 1}": None,
    "": None,
}
UNREADABLE = {"[['a'] ] junk", "[] junk", "bad", "(['t'],)", "[['a']] junk", "[['a']] [['b']]", "[[true]]", "{'a': 1}", ""}


@pytest.fixture(scope="module")
def categories(spark):
    df = spark.createDataFrame([(text,) for text in [*CATEGORIES, None]], "categories string")
    read = read_nested_list(df.withColumn("source", F.col("categories")), "categories")
    return {row["source"]: row for row in read.select("*", first_of_first(F.col("categories")).alias("top")).collect()}


@pytest.mark.parametrize("text", CATEGORIES)
def test_top_category(categories, text):
    assert categories[text]["top"] == CATEGORIES[text]


def test_unreadable_categories_are_marked(categories):
    assert {text for text, row in categories.items() if row["categories_bad"]} == UNREADABLE
    assert categories[None]["categories"] is None


RELATED = {
    "{}": [],
    "[1]": None,
    "{'also_bought': 'x', 'also_viewed': ['3']}": ["3"],
    "{'also_bought': None, 'also_viewed': ['3']}": ["3"],
    "{'bought_together': [], 'zzz': ['9']}": [],
    "{'also_viewed': ['3', None]}": ["3", None],
    "{'also_viewed': [3]}": ["3"],
    "junk": None,
    "": None,
    "{'buy_after_viewing': ['4'], 'also_bought': ['1', '2'], 'also_viewed': ['1']}": ["1", "2", "1", "4"],
    "{'also_viewed': ['1']} x": None,
    "{'also_viewed': (1, 2), 'also_bought': [u'7']}": ["7"],
    r"{'also_viewed': ['\x41']}": ["A"],
    "{'also_viewed': ['a}', 'b']} ": ["a}", "b"],
    "{'other': {'x': 1}, 'also_viewed': ['Nonesuch']}": ["Nonesuch"],
}


@pytest.fixture(scope="module")
def related(spark):
    df = spark.createDataFrame([(text,) for text in [*RELATED, None]], "related string")
    read = read_related(df.withColumn("source", F.col("related")))
    return {row["source"]: row for row in read.select("*", related_ids(F.col("related")).alias("ids")).collect()}


@pytest.mark.parametrize("text", RELATED)
def test_related_ids(related, text):
    row = related[text]
    assert row["related_bad"] is (RELATED[text] is None)
    assert (row["related"] is None) is (RELATED[text] is None)
    assert row["ids"] == (RELATED[text] or [])


def test_workers_do_not_need_the_package(tmp_path):
    """As on a cluster: the package is known to the driver only."""
    program = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from storelens.functions.nested import read_nested_list, read_related
from storelens.session import local_session
spark = local_session(2, memory="1g")
df = spark.createDataFrame([("[[u'x']]", "{{'also_viewed': [u'7']}}")], "c string, related string")
row = read_related(read_nested_list(df, "c")).first()
assert row["c"] == [["x"]] and row["related"]["also_viewed"] == ["7"], row
"""
    run = subprocess.run(
        [sys.executable, "-c", program], cwd=tmp_path, env=ENVIRONMENT, capture_output=True, text=True, timeout=300
    )
    assert run.returncode == 0, run.stderr[-2000:]


def test_null_related(related):
    assert related[None]["related"] is None
    assert related[None]["related_bad"] is False


names = st.text(alphabet=st.characters(codec="utf-8"), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.lists(names, max_size=3), max_size=3), min_size=1, max_size=30))
def test_printed_lists_read_back(spark, lists):
    df = spark.createDataFrame([(i, repr(value)) for i, value in enumerate(lists)], "i int, c string")
    read = read_nested_list(df, "c").collect()
    assert {row["i"]: row["c"] for row in read} == dict(enumerate(lists))
    assert not any(row["c_bad"] for row in read)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.dictionaries(st.sampled_from([*RELATED_LISTS, "other"]), st.lists(names | st.none(), max_size=3)),
        min_size=1,
        max_size=30,
    )
)
def test_printed_dicts_read_back(spark, dicts):
    df = spark.createDataFrame([(i, repr(value)) for i, value in enumerate(dicts)], "i int, related string")
    read = {row["i"]: row for row in read_related(df).collect()}
    for i, value in enumerate(dicts):
        assert read[i]["related"].asDict() == {name: value.get(name) for name in RELATED_LISTS}


def test_odd_text_agrees_with_the_literal_rules(spark):
    pieces = ["[", "]", "'a'", '"b"', ",", " ", "None", "u'c'", "1", "\\", "\n"]
    texts = [f"[{x}[{y}{z}]{x}]" for x in pieces for y in pieces for z in pieces]
    df = spark.createDataFrame([(text,) for text in texts], "text string").withColumn("c", F.col("text"))
    got = {row["text"]: row["top"] for row in
           read_nested_list(df, "c").select("text", first_of_first(F.col("c")).alias("top")).collect()}

    def expected(text):
        try:
            value = ast.literal_eval(text)
        except (ValueError, SyntaxError):
            return None
        top = value[0][0] if value and isinstance(value[0], list) and value[0] else None
        return str(top) if top and not isinstance(top, list) else None

    wrong = {text: (got[text], expected(text)) for text in texts
             if got[text] != expected(text) and "[[" not in text.replace(" ", "")[1:]}
    assert not wrong
