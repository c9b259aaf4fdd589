import hashlib
import re

from rolefit.llm.pii import find, personal_data, redact
from tests.llm.odd import documents, null_rows

# The plain forms.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) \
                    or kind == "phone" and 9 <= len(digits) <= 15:
                out.append((m.start(), n, kind, m.end()))
    return sorted(out)


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        spans = base(texts[r.doc_id])
        said = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, _, x, _ in spans) for k in PLAIN]
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = personal_data(docs).collect()
    assert sum(r.n_email for r in rows) > 10
    check(rows, {r.doc_id: r.text for r in docs.collect()})


def test_hard_texts(spark):
    texts = [
        "a@b.c_x@d.e x@y@z.com .@-.-", "a" * 30000 + "@", "1" * 30000, "1-" * 20000 + "1", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255", "+1(((((((2 +12 +1 234 567 890 +1+2 345678901 x",
        "4524132264652876 4524-1322-6465-2876 4524 1322 6465 2877 5", "é\U0001f600 bob@x.org \U0001f600 1.2.3.4", "a.b@c.d.e-f.g@h.i", None, "", "@" * 1000 + "+" * 1000, "%@%.% x@y.z.",
    ]
    check(personal_data(documents(spark, texts)).collect(), dict(enumerate(texts)))


def test_patterns_find_what_no_base_pattern_matches(spark):
    seeds = [f"we wrote mail at user{i}@mail.example and left" for i in range(12)]
    unseen = ["we wrote mail at carol(at)mail9 and left", "room number 12 is open", "see the chapter 9999 again"]
    docs = documents(spark, seeds + unseen)
    rows = {r.doc_id: r for r in personal_data(docs).collect()}
    at = unseen[0].index("carol")
    assert rows[12].spans == f"email:{at}:{at + len('carol(at)mail9')}" and rows[12].n_email == 0
    assert rows[13].spans == rows[14].spans == ""
    text = {r.doc_id: r.text for r in redact(docs).collect()}
    assert text[0] == "we wrote mail at [EMAIL] and left" and text[12] == "we wrote mail at [EMAIL] and left" and text[13] == unseen[1]


def test_a_list_of_identifiers_is_found_to_its_end(spark):
    seeds = [f"team list user{i}@mail.example peer{i}@mail.example third{i}@mail.example today" for i in range(12)]
    unseen = "team list ann(at)mail7 bob(at)mail8, cid(at)mail9 today"
    long = "x" * 80
    texts = [*seeds, unseen, *(f"{long}{i % 2} {'y' * 70} id{i}@mail.example" for i in range(8)), "z" + "x" * 79 + " " + "y" * 70 + " room12"]
    rows = {r.doc_id: r for r in personal_data(documents(spark, texts)).collect()}
    found = [unseen[int(a):int(b)] for _, a, b in (s.split(":") for s in rows[12].spans.split(","))]
    assert found == ["ann(at)mail7", "bob(at)mail8", "cid(at)mail9"] and rows[12].n_email == 0
    assert rows[21].spans == ""  # other words before, though their tails are the same


def test_found_instances_seed_further_patterns(spark):
    """Three contexts in a row, the second and third without a base entity; a pattern's own vote proves nothing."""
    texts = [f"we wrote mail at user{i}@mail.example and left" for i in range(400)]
    texts += [f"we wrote mail at one{i}(at)mail and left" for i in range(20)] + [f"please reach via one{i}(at)mail today" for i in range(20)]
    texts += [f"please reach via two{i}(at)mail today" for i in range(3)] + [f"now page using two{i}(at)mail 1" for i in range(3)]
    texts += [f"half known name{i}@mail.example" for i in range(6)] + [f"half known item{i}" for i in range(4)]
    rows = {r.doc_id: r for r in personal_data(documents(spark, texts)).collect()}
    marked = lambda i: [texts[i][int(a):int(b)] for _, a, b in (s.split(":") for s in rows[i].spans.split(",") if s)]
    assert all(marked(i) == [texts[i].split()[-2]] for i in range(400, 440) if "via" in texts[i])
    assert [marked(i) for i in range(440, 443)] == [[f"two{i}(at)mail"] for i in range(3)]
    assert [marked(i)[:1] for i in range(443, 446)] == [[f"two{i}(at)mail"] for i in range(3)]
    assert not any(marked(i) for i in range(452, 456))


def test_odd_rows(spark):
    docs = documents(spark)
    check(personal_data(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert personal_data(documents(spark, empty=True)).count() == 0 and personal_data(null_rows(spark)).count() == 4
    out = redact(docs)
    assert out.columns == docs.columns
    new = {r.doc_id: r for r in out.collect()}
    for r in docs.collect():
        spans = base(r.text)
        assert (new[r.doc_id].text == r.text) == (not spans) and not base(new[r.doc_id].text)
        assert new[r.doc_id].text is None or new[r.doc_id].n_chars == len(new[r.doc_id].text)
    assert redact(null_rows(spark)).count() == 4 and find(docs.limit(0)).count() == 0
