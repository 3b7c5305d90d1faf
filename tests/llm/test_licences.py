from opsmetrics.llm.license_scan import LICENCE_SQL, scan_licences
from opsmetrics.llm.license_texts import BSD_2, LICENCES, MIT
from opsmetrics.llm.queries import op9_licence_digests
from tests.comparison import difference, duckdb_on
from tests.llm.conftest import SF
from tests.llm.rows import clashing, frame


def test_equals_sql(spark):
    assert difference(op9_licence_digests(spark, SF), LICENCE_SQL, duckdb_on(SF)) is None


def test_every_text_has_its_own_name(spark):
    rows = [(i, t, None, None, None) for i, (_, t) in enumerate(LICENCES)]
    found = {r.doc_id: r.licence for r in scan_licences(frame(spark, rows)).collect()}
    assert found == {i: n for i, (n, _) in enumerate(LICENCES)}


def test_other_spellings(spark):
    rows = [
        (1, "Copyright (c) 2020 Some One\n\n" + MIT.upper(), None, None, None),
        (2, BSD_2.replace(",", " ,").replace("\n", "  \r\n"), None, None, None),
        (3, MIT.replace("License", "Licence").replace('"', "“"), None, None, None),
        (4, MIT + " and more", None, None, None),
        (5, "text\nReleased under the MIT Licence!\nmore", None, None, None),
    ]
    found = {r.doc_id: (r.licence, r.notices) for r in scan_licences(frame(spark, rows)).collect()}
    assert found[1][0] == "MIT" and found[2][0] == "BSD-2-Clause" and found[3][0] == "MIT"
    assert found[4][0] is None and found[5] == (None, "1:MIT")


def test_awkward_rows(spark):
    assert scan_licences(clashing(frame(spark))).count() == 17
    assert scan_licences(frame(spark, [])).count() == 0
