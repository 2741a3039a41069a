from samples import clashing, documents, odd_documents, prose

from imageset_spark.llm import licenses

LONG = dict(t[::-1] for t in licenses.TEMPLATES)


def model(text):
    """Licenses by exact containment anywhere in a run of twice the template's length."""
    import re

    def cut(x):
        w = re.findall(r"[^\s!-/:-@\[-`{-~]+", (x or "").lower())
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    have, out = cut(text), set()
    for name, template in licenses.TEMPLATES:
        need = set(cut(template))
        m = len(need)
        if any(len(need & set(have[i : i + 2 * m])) >= 0.75 * m for i in range(0, max(len(have), 1), m)):
            out.add(name)
    return ",".join(sorted(out))


def report(spark, texts, **options):
    out = licenses.license_report(documents(spark, list(enumerate(texts))), **options).collect()
    return {r.doc_id: r for r in out}


def test_matches_agree_with_exact_containment(spark):
    notices = [text for _, text in licenses.TEMPLATES]
    texts = [prose(40 + 7 * i, i) + "\n" + n + "\n" + prose(5 * i, 90 + i) for i, n in enumerate(notices)]
    texts += [n.upper().replace(",", " ;") for n in notices] + [" ".join(n.split()[: len(n.split()) // 2]) for n in notices]
    texts += ["".join(notices), " ".join(prose(20, 40 + i) + " " + n for i, n in enumerate(notices)), prose(3000, 2)]
    changed = notices[4].split()
    changed[len(changed) // 2] = "other"
    texts.append(" ".join(changed))
    out = report(spark, texts)
    assert {i: out[i].licenses for i in out} == {i: model(t) for i, t in enumerate(texts)}
    assert all(out[i].licenses for i in range(len(notices)))
    assert out[len(texts) - 2].n_licenses == 0


def test_every_occurrence_lies_whole_in_a_window(spark):
    notice = licenses.TEMPLATES[6][1]
    out = report(spark, [prose(n, 3) + " " + notice + " " + prose(9, 4) for n in range(1, 60, 3)])
    assert all("GPL-3.0" in r.licenses for r in out.values())


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = licenses.license_report(docs).collect()
    assert len(out) == docs.count() and not any(r.n_licenses for r in out)
    assert licenses.license_report(clashing(documents(spark, []))).collect() == []
    assert report(spark, ["Released under the MIT License."], templates=[])[0].n_licenses == 0
    same = documents(spark, [(1, licenses.TEMPLATES[0][1])] * 3 + [(None, licenses.TEMPLATES[0][1])])
    assert [r.licenses for r in licenses.license_report(same).collect()] == ["Apache-2.0"] * 4
    tail = documents(spark, [(1, prose(20_000, 1) + " Released under the MIT License.")])
    assert licenses.license_report(tail).first().licenses == "MIT"
