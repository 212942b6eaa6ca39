"""Every registered query against its SQL on the smallest tables."""

import hashlib
import io
import os
import re

import pyarrow.parquet as pq
import pytest

from __spark_entry__ import entry
from checks.compare import connect, difference
from checks.queries import ORACLE, QUERIES
from exposcan import fixed_values as fv

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_every_query_has_sql():
    """But for the listing: SQL sees tables, not the folder they are in."""
    assert set(QUERIES) - set(ORACLE) == {"s11_list_files"} and set(ORACLE) <= set(QUERIES)


def test_the_listing_is_that_of_the_operating_system(spark):
    got = {(r["path"], r["name"], r["size"], r["is_link"]) for r in QUERIES["s11_list_files"](spark, SF).collect()}
    assert got == {(os.path.join(top, n), n, os.lstat(os.path.join(top, n)).st_size, os.path.islink(os.path.join(top, n))) for top, _, names in os.walk(SF) for n in names}


def test_entry_equals_a_plain_reading(spark):
    """The lane in a few lines of Python: equal texts once, first context per address."""
    expected, seen = set(), set()
    for doc in pq.read_table(f"{SF}/documents.parquet").sort_by("doc_id").to_pylist():
        if doc["text"] in seen:
            continue
        seen.add(doc["text"])
        emails = {}
        for line in io.StringIO(doc["text"].replace("\r\n", "\n").replace("\r", "\n")):
            for m in re.finditer(fv.RFC_EMAIL, line):
                if re.match(fv.STRICT_EMAIL, m.group()):
                    at = line.find(m.group())
                    emails.setdefault(m.group(), line[max(at - 150, 0):at + len(m.group()) + 150].strip())
        expected |= {(doc["doc_id"], e, c, hashlib.sha1(f"{e}_{c}".encode()).hexdigest()) for e, c in emails.items()}
    got = entry(spark).select("file", "email", "email_context", "id").collect()
    assert expected and sorted(map(tuple, got)) == sorted(expected)
