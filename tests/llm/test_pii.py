import hashlib
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from caseflow.llm import pii, queries

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def valid(kind, s):
    digits = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if valid(k, m[0])]
    return sorted(found)


FINDER = pii.Finder()


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(["@", ".", "1", "2", "0", "25", "256", "+", " ", "-", "(", ")", "a", "b.c", "é", "a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (619) 555-0053", "\n", "٣"]), max_size=25).map("".join))
def test_base_spans_equal_patterns(text):
    assert [s for s in FINDER.spans(text) if s[1] < 4] == brute(text)


ADDED = {
    "url": r"[A-Za-z0-9+.-]+://(?:[^\s/?#@\"'<>]*@)?(?P<host>[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)(?::[0-9]+)?(?:[/?#][^\s\"'<>]*)?",
    "account": r"(?=(?P<cue>CUES)(?P<more>[A-Za-z0-9_]*)[\"']?[ ]?[=:][ ]?[\"']?(?P<value>[A-Za-z0-9_+/=.-]{6,}))",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9_-])(?:AKIA[A-Za-z0-9_-]{16,}|ghp_[A-Za-z0-9_-]{36,}|xoxb-[A-Za-z0-9_-]{10,})",
}


def brute_added(text):
    """Url, account, iban and key spans by plain patterns, every place of an account word tried by itself."""
    out = []
    for m in re.finditer(ADDED["url"], text):
        if m[0][0].isalpha():
            end = m.end("host") + len(text[m.end("host") : m.end()].rstrip(".,;:!?)]}"))
            out.append((m.start(), "url", end))
    done = 0
    forms = "|".join(f for c in pii.CUES for f in (c, c.upper(), c.capitalize()))
    for m in re.finditer(ADDED["account"].replace("CUES", forms), text):
        if m.start() >= done and len(m["cue"] + m["more"]) <= 16 and re.search("[0-9]", m["value"]):
            out.append((m.start("value"), "account", m.end("value")))
            done = m.end("value")
    for m in re.finditer(ADDED["iban"], text):
        s = m[0].replace(" ", "")
        digits = "".join(str(int(c, 36)) for c in s[4:] + s[:4])
        if len(s) <= 34 and int(digits) % 97 == 1:
            out.append((m.start(), "iban", m.end()))
    return sorted(out + [(m.start(), "key", m.end()) for m in re.finditer(ADDED["key"], text)])


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["http", "://", "a", "b.c", "1", "/", "?q=", ".", " ", "u:p@", "@", "token", "password", "=", ":", '"', "abcdef", "x1y2z3", "_",
                                 "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE88", " 3704 0044", "AKIA", "IOSFODNN7EXAMPLE", "xoxb-", "\n"]), max_size=16).map("".join))
def test_added_spans_equal_patterns(text):
    got = [(a, pii.KINDS[k], b) for a, k, b in FINDER.spans(text) if k >= 4]
    assert sorted(got) == brute_added(text)


def test_long_runs_are_linear():
    runs = ["1", "1.1", "a@", "+1", "1 -", "password", "://", "token=", "1://b.c/", "a://", "A1", "AKIA", "DE89 ", "token=a ", "a://b@", "a://b:"]
    for text in (*((r * (1_000_000 // len(r))) for r in runs), "a" * 1_000_000 + "@", "token=" * 30_000 + "1"):
        began = time.process_time()
        FINDER.spans(text)
        assert time.process_time() - began < 8, text[:20]


def test_query_equals_patterns(spark):
    got = {r.doc_id: r for r in queries.op7_personal_data(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    kinds, some = list(PATTERNS), 0
    for d in docs:
        base = brute(d.text or "")
        some += len(base)
        r = got[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        joined = [f"{kinds[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in kinds] == joined
    assert some > 50 and len(got) == len(docs)


def test_defined_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "a@b.c", None), (None, "see https://x.example.org/p?q=1. token = \"abc12345\"", "y"), (4, "w " * 30_000 + "1.2.3.4", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in pii.find_personal_data(df).collect()), key=str)
    assert got == sorted([(1, []), (2, []), (2, [("email", 0, 5)]), (None, [("url", 4, 31), ("account", 42, 50)]), (4, [("ip", 60000, 60007)])], key=str)
    assert pii.find_personal_data(df.limit(0)).count() == 0
    masked = {r.doc_id: r.masked for r in pii.mask_personal_data(df.where("doc_id IS NULL")).collect()}
    assert masked[None] == "see [url]. token = \"[account]\""
