import hashlib
import re

from samples import clashing, documents, odd_documents, prose

from imageset_spark.llm import secrets

PATTERNS = (
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
HEX, KEY, LOOSE = "0123456789abcdef" * 3, "AKIA" + "Q7" * 8, "gT7" + "xY4pQ9" * 4


def model(text):
    spans = []
    for k, (kind, pattern, group, least) in enumerate(PATTERNS):
        spans += [(m.start(), k, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans)]


TEXTS = [
    "password = hunter22222", "password: token: abcdefghij", "PASSWD='x' api_key=\"abcd1234-=\"", f"é𝒳 {HEX}{KEY}",
    f"token={HEX} and again secret : {KEY}", "AKIA" + "A" * 11, "AKIAAKIA" + "B" * 9, f"{LOOSE} here", "apikey=a.b.c.d.e",
    f"x{HEX}G{HEX}", "token = " + HEX * 3 + "\nsecret=short", "token=token=token=abc",
]


def test_base_findings_match_the_model(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    got = {r.doc_id: r for r in secrets.secret_report(docs).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        spans = model(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("loose")] == spans
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(
            sum(s.startswith(k) for s in spans) for k, *_ in PATTERNS)


def test_ownership_separates_copied_from_live(spark):
    rows = [(i, f"see {LOOSE} ok", "en", f"owner{i % 5}") for i in range(20)]
    rows += [(50, f"mine {LOOSE[::-1]}", "en", "owner1"), (51, f"token={HEX}", "en", "owner1")]
    found = {(r.id, r.kind): r for r in secrets.scan_secrets(documents(spark, rows)).collect()}
    # Five owners share the first value: a copied example, which the loose kind leaves out.
    assert set(found) == {(50, "loose"), (51, "assign"), (51, "hex")}
    assert found[50, "loose"]["class"] == "live" and found[50, "loose"].n_owners == 1
    assert found[51, "hex"].n_repos == 1


def test_loose_candidates_never_overlap_base_findings(spark):
    docs = documents(spark, [(1, f"token={LOOSE} {LOOSE[::-1]}")])
    spans = secrets.secret_report(docs).first().spans.split(",")
    assert [s.split(":")[0] for s in spans] == ["assign", "loose"]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = secrets.secret_report(docs).collect()
    assert len(got) == docs.count() and all(r.spans == "" for r in got)
    empty = secrets.secret_report(clashing(documents(spark, []))).collect()
    assert empty == []


def test_repeated_rows_and_many_findings(spark):
    text = " ".join(f"token=value{i:06d}" for i in range(3000)) + prose(50, 1)
    got = secrets.secret_report(documents(spark, [(1, text, "en", None), (1, text, "en", None), (None, text)])).collect()
    assert [r.n_assign for r in got] == [3000] * 3
    assert got[0].spans == ",".join(model(text))
