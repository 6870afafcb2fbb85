"""An IBAN ends by its country's length, whatever follows."""

from adweave.llm import pii

A, B, C = "DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "NO9386011117947"
FR = "FR14 2004 1010 0505 0001 3M02 606"


def test_what_follows_an_iban(spark):
    cases = [(f"{a}{end}", [a]) for a in (A, B, C, FR) for end in (
        " Please pay", " 4711 and more", " BIC COBADEFFXXX", " X", ".", "", " 12", " A B C D E F")]
    cases += [(f"{A} {B} {C}", [A, B, C]), (f"AB12 CDEF {A} END", [A]), (f"{A}X", []), (f"x{A}", []),
              ("DE88370400440532013000 Please", []), (f"IBAN {FR} {A} BIC", [FR, A]),
              ("XX19 1234 5678 9012 3456 please", []), ("A" * 100_000 + " " + A, [A]),
              ("DE12 " * 20_000 + A, None), ("AB12 " * 20_000, None)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id bigint, text string")
    out = pii.findings(df).withColumn("left", pii.redacted()).orderBy("doc_id").collect()
    for row, (text, want) in zip(out, cases):
        found = [text[s.start:s.end] for s in row.spans if s.kind == "iban"]
        assert want is None or found == want, (text[:80], found)
    assert out[0].left == "[IBAN] Please pay"


def test_an_unlisted_country_before_a_capital(spark):
    text = next(f"ZZ{k:02d}123456789012345678" for k in range(2, 99)
                if int(f"1234567890123456783535{k:02d}") % 97 == 1)
    row = pii.findings(spark.createDataFrame([(1, text + " Please")], "doc_id bigint, text string")).first()
    assert [(s.kind, s.start, s.end) for s in row.spans] == [("iban", 0, len(text))]
