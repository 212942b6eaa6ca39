"""Listing of every file, and the run from a folder to index and ledger."""

import os

import pytest

from checks.queries import write_by_doc
from exposcan import session
from exposcan.operators import sinks
from exposcan.plans.folder import VERDICTS, run_folder
from exposcan.sources.files import read_pieces
from exposcan.sources.listing import ListingReader, list_all_files

SOURCES = "id int, post_title string, indexed string, discovered string"


@pytest.fixture
def dump(tmp_path):
    root = tmp_path / "dump"
    line = "write to u{}@example.com today\n"
    long = "padding " * 80 + "\n"
    for name, content in {
        "a/Note.TXT": line.format(1) + long, "b/Note.TXT": line.format(2) + long, "copy of a.md": line.format(2) + long, "none": long + "nobody here\n",
        "small.txt": line.format(3), "tool.exe": long, "scan.pdf": long, "a/.hidden.txt": line.format(4) + long, "_folder/x.txt": line.format(5) + long,
        "people.csv": "id,Email\n" + "".join(f'{n},"p{n}@example.com\nnote"\n' for n in range(30)), "plain.csv": "id,x\n" + "1,2\n" * 200,
        "late.CSV": "id,x\n" + "1,2\n" * 200 + "1,late@example.com\n",
        "with space+plus.xml": "<r><email/><p>x@example.com</p>" + long + "</r>", "broken.xml": "<r>email " + long, "other.xml": "<r>" + long + "</r>",
    }.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
    (root / "link.txt").symlink_to(root / "a/Note.TXT")
    (root / "folder_link").symlink_to(root / "a")
    (root / "gone.txt").symlink_to(root / "nowhere")
    return root


@pytest.mark.parametrize("folders", [1, 2, 1000])
def test_listing_has_hidden_names_and_links(spark, dump, folders):
    got = {r["path"]: (r["name"], r["ext"], r["size"], r["is_link"]) for r in list_all_files(spark, str(dump), folders).collect()}
    want = {}
    for top, _, names in os.walk(dump):
        for name in names:
            path = os.path.join(top, name)
            ext = os.path.splitext(name)[1][1:].lower()
            want[path] = (name, ext, os.lstat(path).st_size, os.path.islink(path))
    assert got == want and sum(v[3] for v in got.values()) == 2


def test_listing_is_dealt_by_folder(dump):
    parts = ListingReader(str(dump), 1000).partitions()
    assert sorted(os.path.relpath(p.path, dump) for p in parts) == [".", "_folder", "a", "b"] and not any(p.below for p in parts)
    assert [p.below for p in ListingReader(str(dump), 1).partitions()] == [True]
    assert list(ListingReader(str(dump / "missing"), 5).read(ListingReader(str(dump / "missing"), 5).partitions()[0])) == []


def test_listing_of_many_folders_has_few_tasks(spark, tmp_path):
    for n in range(1200):
        (tmp_path / f"d{n}/below").mkdir(parents=True)
        (tmp_path / f"d{n}/below/f.txt").write_text("x" * (n % 7))
    (tmp_path / "top.txt").write_text("y")
    assert len(ListingReader(str(tmp_path), 1000).partitions()) <= 1000
    got = sorted((r["path"], r["size"]) for r in list_all_files(spark, str(tmp_path)).collect())
    assert got == sorted([(str(tmp_path / f"d{n}/below/f.txt"), n % 7) for n in range(1200)] + [(str(tmp_path / "top.txt"), 1)])


def test_run_from_a_folder(spark, dump, tmp_path):
    sources = spark.createDataFrame([(7, "leak", "2025", "2024")], SOURCES)
    root = str(tmp_path / "index")
    ledger = run_folder(spark, str(dump), sources, 7, root, sinks.RAW)
    got = {os.path.relpath(r["path"], dump): (r["verdict"], r["findings"]) for r in ledger.collect()}
    assert got == {
        "a/Note.TXT": ("replaced", 0), "b/Note.TXT": ("found", 1), "copy of a.md": ("copy", 0), "none": ("nothing_found", 0), "small.txt": ("small", 0),
        "tool.exe": ("unknown_extension", 0), "scan.pdf": ("needs_decoder", 0), "a/.hidden.txt": ("hidden", 0), "_folder/x.txt": ("hidden", 0),
        "people.csv": ("found", 30), "plain.csv": ("no_contact", 0), "late.CSV": ("no_contact", 0), "with space+plus.xml": ("found", 1),
        "broken.xml": ("not_parsed", 0), "other.xml": ("no_contact", 0), "link.txt": ("link", 0), "gone.txt": ("link", 0),
    }
    assert {v for v, _ in got.values()} == set(VERDICTS)
    found = sinks.read_findings(spark, root).collect()
    assert len(found) == 32 and {r["id_source"] for r in found} == {7}
    assert {r["from"] for r in found} == {"Note.TXT Note.TXT.json", "transformed_people.json", "with space+plus.json"}
    # The same folder again changes nothing.
    run_folder(spark, str(dump), sources, 7, root, sinks.RAW)
    assert sorted(map(tuple, sinks.read_findings(spark, root).collect())) == sorted(map(tuple, found))
    # Findings of a source that is not registered do not get in.
    run_folder(spark, str(dump), sources, 8, str(tmp_path / "other"), sinks.RAW)
    assert sinks.read_findings(spark, str(tmp_path / "other")).count() == 0


def test_documents_are_written_as_the_engine_writes_them(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, None), (2, "\u00e9" * 400), (None, "n"), (3, "")], "doc bigint, value string").repartition(2, "doc")
    rows.write.partitionBy("doc").text(str(tmp_path / "a"))
    write_by_doc(rows, str(tmp_path / "b"))

    def read(root):  # one data file and its checksums in each folder; their names differ by run
        return {d.name: sorted((f.suffix, sorted(f.read_bytes()) if f.suffix == ".txt" else f.read_bytes()[:8], f.stat().st_size) for f in d.iterdir()) for d in root.glob("doc=*")}

    assert read(tmp_path / "a") == read(tmp_path / "b") and len(read(tmp_path / "a")) == 4
    assert sorted(r.value for r in spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "b")).collect()) == sorted(["a", "", "\u00e9" * 400, "n", ""])


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    for n in range(120):
        (tmp_path / f"d{n}").mkdir()
        (tmp_path / f"d{n}" / "x.txt").write_text("x\n")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 << 20))
    try:
        with session.many_files(spark):
            assert read_pieces(spark, str(tmp_path)).rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
        assert read_pieces(spark, str(tmp_path)).rdd.getNumPartitions() >= 30 and spark.conf.get("spark.sql.files.openCostInBytes") == before
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
