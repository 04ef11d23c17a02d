"""Personal data: base spans against Python's re, discovery, masking."""

from __future__ import annotations

import hashlib
import random
import re

from fleetspark.llm.pii import base_spans, mask_personal_data, personal_data, span_report

SCHEMA = "doc_id long, text string, n_chars long, base string, kind int, spans string"
KINDS = ("email", "ip", "card", "phone")


def luhn(digits: str) -> bool:
    return sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(map(int, reversed(digits)))) % 10 == 0


def plain(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m)) <= 15:
            out.append(("phone", *m.span()))
    return out


def named(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


ODD = ["", None, "a@b.c_x@d.e %@q.r.", "x@y a@b. a@b..c @c.d a@b.c@d.e..f@g.h.i-", "..a.@b-.c- _@_._ a@b.c.", "@ab .x@a.bc.d",
       "1.2.3.4.5.6.7.8.9 256.1.1.1 1.2.3 001.002.003.0255 1.2.3.4. 12345.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111",
       "4111  1111 1111 1111 1 - 4111111111111111", "41111111111111111 4111111111111112 1 4111111111111111", "4111111111111111-", "+1 2 +1 (771) 555-1655 +12345678 +1-2-3",
       "+123456789012345 +1234567890123456 ++1 22222222+33333333", "é🙂 +1 771 555 1655 🙂 a@b.cd 🙂 9.9.9.9", "1 " * 20_000, "a." * 20_000 + "@b.c",
       "q@" + "b." * 20_000 + "c", "x" * 200_000 + "1", "1.2.3." * 10_000, "+1(" * 5_000 + "5", "9" * 50_000, "a@b.c" * 300]


def random_texts() -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choice("aZ09.@-+ _%()\n1234") for _ in range(rng.randrange(120))) for _ in range(300)]


def test_base_spans_against_re(spark):
    texts = ODD + random_texts()
    df = spark.createDataFrame([(i, t, 0, "b", 1, "s") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in span_report(personal_data(df)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = plain(t)
        assert got[i].base_sha256 == hashlib.sha256(named(want).encode()).hexdigest(), repr(t)[:80]
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in want) for k in KINDS]
        assert set(named(want).split(",")) <= set(got[i].spans.split(","))
    assert [c for c in base_spans(df).columns if c.startswith("hit")] == []


def test_contexts_discover_identifiers(spark):
    seeds = [(i, f"reach us: {i}@x.org please", 0, "", 0, "") for i in range(30)]
    hidden = [(50, "reach us: +1 2 please", 0, "", 0, "")]
    cards = [(100 + i, f"my card no 4111-1111-1111-{n} expires", 0, "", 0, "")
             for i, n in enumerate(n for n in range(1000, 1300) if luhn(f"411111111111{n}"))]
    typo = [(900, "my card no 4111-1111-1111-1001 expires", 0, "", 0, ""), (901, "part 4111-1111-1111-1001 in stock", 0, "", 0, ""),
            (902, "part 5555-6666-7777-8888-9 in stock", 0, "", 0, "")]
    assert not luhn("4111111111111001")
    df = spark.createDataFrame(seeds + hidden + cards + typo, SCHEMA)
    got = {r.doc_id: r.spans for r in span_report(personal_data(df)).collect()}
    assert got[900] == "card:11:30" and got[901] == "card:5:24"
    assert got[902] == "" and got[50] == "" and got[3] == "email:10:17"


def test_contexts_discover_unseen_forms(spark):
    rows = [(i, f"please call me at +49 30 55{i:05d} or write", 0, "", 0, "") for i in range(40)]
    rows += [(100 + i, f"my mail is user{i}@x.org thanks", 0, "", 0, "") for i in range(40)]
    rows += [(200 + i, f"see note under +49 30 77{i:05d} or file", 0, "", 0, "") for i in range(10)]
    rows += [(300 + i, f"see note under A{i:06d} or file", 0, "", 0, "") for i in range(10)]
    rows += [(400, "please call me at 030-1234567 or write", 0, "", 0, ""), (401, "my mail is id_77812345 thanks", 0, "", 0, ""),
             (402, "the order has no 99812345 in all", 0, "", 0, ""), (403, "55512345", 0, "", 0, ""), (404, "at 66612345", 0, "", 0, "")]
    rows += [(500 + i, f"{i}@x.org", 0, "", 0, "") for i in range(20)]
    got = {r.doc_id: r.spans for r in span_report(personal_data(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got[400] == "phone:18:29" and got[401] == "email:11:22"
    assert [got[i] for i in (402, 403, 404)] == [""] * 3 and all(got[300 + i] == "" for i in range(10))


def test_masking_keeps_rows_columns_and_clean_text(spark):
    rows = [(1, "mail a@b.c now", 14, "x", 1, "y"), (2, "clean text", 10, "x", 1, "y"), (2, "clean text", 10, "x", 1, "y"),
            (None, "ip 1.2.3.4", 10, "x", 1, "y"), (3, None, 0, "x", 1, "y"), (4, "+1 771 555 1655, 4111111111111111", 33, "x", 1, "y"),
            (5, "+4111111111111111", 17, "x", 1, "y"), (1, "mail a@b.c now", 14, "x", 1, "y"), (1, "5 b@c.d", 7, "x", 1, "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mask_personal_data(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id or 0), r.text or "", r.n_chars) for r in out.collect()) == [
        (0, "ip <IP>", 7), (1, "5 <EMAIL>", 9), (1, "mail <EMAIL> now", 16), (1, "mail <EMAIL> now", 16), (2, "clean text", 10),
        (2, "clean text", 10), (3, "", 0), (4, "<PHONE>, <CARD>", 15), (5, "+<CARD>", 7)]
    assert mask_personal_data(df.limit(0)).collect() == [] and personal_data(df.limit(0)).collect() == []
