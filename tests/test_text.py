import re
import sys
import unicodedata

from pyspark.sql import functions as F

from ledgerline.functions import text as tx
from ledgerline.operators import audits


def plain(value):
    value = unicodedata.normalize("NFKC", value or "").lower()
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", value)).strip()


def test_normalise_examples(spark):
    texts = [None, "", "  ", "Joe's  CAFE & Co.", "Ｆｕｌｌ ﬁne ½ Ⅷ ²", "हिन्दी कंपनी", "a_b\tc d\x1ce", "ÉCOLE d'Été", "tab\x85next"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r.k: r.n for r in df.select("k", tx.normalise(F.col("t")).alias("n")).collect()}
    assert got == {k: plain(t) for k, t in enumerate(texts)}


def test_normalise_every_code_point(spark):
    """Alike but for code points that one side's Unicode tables don't have."""
    cps = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, f"a{chr(c)}b") for c in cps], "c int, t string")
    got = {r.c: r.n for r in df.select("c", tx.normalise(F.col("t"), nfkc=False).alias("n")).collect()}
    odd = [c for c in cps if got[c] != re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", f"a{chr(c)}b".lower())).strip()]
    assert len(odd) < 6000 and not [c for c in odd if c < 0x0300]


ADDRESSES = ["", "   ", "NULL", "<null>", "[ N/A ]", "1 St, NULL, City", "1 St null", "1 St n/a", "1 St N/a", "Na, X", "NULL, NULL", "#NULL", "a null", None, "<", "(unknown)", "<>"]


def test_placeholders(spark):
    df = spark.createDataFrame([("d", "s", a) for a in ADDRESSES], "dataset string, source string, business_address string")
    r = audits.placeholder_field_summary(df).first()
    assert (r.total_rows, r.empty_string_count, r.whitespace_only_count, r.whole_field_placeholder_count) == (17, 2, 1, 4)
    assert r.effectively_missing_count == 7 and r.nonempty_address_count == 10
    assert (r.rows_with_component_placeholder_cleaned, r.rows_with_component_placeholder_raw_ws, r.rows_clean_nonempty) == (7, 5, 3)
    assert r.pandas_nan_count == 3
    t = {x.token: x for x in audits.placeholder_token_summary(df).collect()}
    assert len(t) == 7 and t["undefined"].component_rows_cleaned == 0
    n = t["null"]
    assert (n.whole_field_rows, n.component_token_occurrences_cleaned, n.component_rows_cleaned, n.component_token_occurrences_raw_ws) == (2, 5, 4, 3)
    assert (n.case_uppercase, n.case_lowercase, n.punct_surrounded, n.whitespace_isolated) == (3, 2, 2, 3)
    assert (t["n/a"].case_lowercase, t["n/a"].case_other, t["na"].case_titlecase) == (1, 1, 1)
