import pytest

from ledgerline.operators.validation import validate_results
from ledgerline.sources.sinks import write_validation_log


@pytest.fixture
def files(tmp_path):
    (tmp_path / "test_source1.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\ta\tb\tUS\nS1-2\ta\tb\tUS\n")
    (tmp_path / "ids.tsv").write_text("entity_id\tx\nS2-100\tx\nS3-5\tx\n")

    def write(name, text):
        (tmp_path / name).write_bytes(text if isinstance(text, bytes) else text.encode())
        return str(tmp_path / name)

    return write, str(tmp_path / "test_source1.tsv"), str(tmp_path / "ids.tsv")


def test_pass(spark, files, tmp_path):
    write, s1, ids = files
    v = validate_results(spark, write("m.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-100\nS1-2\t\n"), s1, None, (ids,), True)
    assert (v.status, v.exit_code, v.errors) == ("PASS", 0, [])
    assert v.statistics["m.tsv"] == {"n_rows": 2, "n_empty": 1, "n_non_empty": 1}
    write_validation_log(v, str(tmp_path / "v.log"), "validate")
    assert (tmp_path / "v.log").read_text().splitlines()[:3] == ["status: PASS (0)", "command: validate", "m.tsv: 2 rows (1 empty, 1 non-empty)"]


def test_fatal(spark, files):
    write, s1, _ = files
    assert "COMMA" in validate_results(spark, write("c.tsv", "source1_entity_id,matched_entity_ids\nS1-1,S2-1\n"), s1).errors[0]
    assert "unexpected header" in validate_results(spark, write("h.tsv", "a\tb\n"), s1).errors[0]
    assert "empty" in validate_results(spark, write("e.tsv", ""), s1).errors[0]
    assert "UTF-8" in validate_results(spark, write("u.tsv", b"source1_entity_id\tmatched_entity_ids\nS1-1\t\xff\xfe\n"), s1).errors[0]
    assert "not found" in validate_results(spark, "/nowhere.tsv", s1).errors[0]
    assert "not found" in validate_results(spark, s1, "/nowhere.tsv").errors[0]


def test_every_rule(spark, files):
    write, s1, ids = files
    text = "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-100,S2-100\nS1-1\tS1-9\nno tab here\n\nS1-8\tX-1, S2-100,S2-404\n"
    v = validate_results(spark, write("m.tsv", text), s1, write("c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-100\nS1-2\t\n"), (ids,), True)
    joined = "\n".join(v.errors)
    for part in ("line 4", "duplicate source1_entity_id row(s): S1-1", "repeated ID inside a matched_entity_ids list for: S1-1", "self-matches): S1-9", "prefix:  S2-100, X-1", "Source-2/3 files: S2-404", "missing: S1-2", "not in the test set: S1-8"):
        assert part in joined, part
    assert any("2 S1 entity(ies)" in w for w in v.warnings)
    assert v.exit_code == 1


def test_many_malformed_rows_and_unreadable_files(spark, files, monkeypatch):
    from ledgerline.operators import validation

    monkeypatch.setattr(validation, "MALFORMED_SHOWN", 2)
    write, s1, _ = files
    v = validate_results(spark, write("m.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\t\nS1-2\t\nx\ny\nz\n"), s1)
    assert v.errors[:3] == ["m.tsv: malformed row (no tab) at line 4", "m.tsv: malformed row (no tab) at line 5", "m.tsv: 1 more malformed row(s) (no tab)"]
    broken = validate_results(spark, "nosuchstore://x/m.tsv", s1)
    assert broken.exit_code == 1 and broken.errors[0].startswith("Could not read a file")
