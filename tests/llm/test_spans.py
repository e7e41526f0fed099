import random
import re

from data import AWKWARD, documents, prose

from roispark.llm import pii, secrets

ASSIGN = re.compile("((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
                    "|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def scattered(pieces, seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def test_secret_spans_match_plain_search():
    pieces = ["password", "PassWd", "secret", "token", "api_key", "apikey", "=", ": ", '"', "'", " ", "AKIA", "A1B2C3D4E5F6G7H8",
              "deadbeef", "0123", "abcdef", "x", "é", "İ", "-", "ab12" * 4, "\n"]
    for text in scattered(pieces, 3):
        want = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        assert [s for s in secrets.find_secrets(text) if s[1] < 3] == sorted(want)


def test_checksum_decides():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = "ghp_" + body + secrets.checksum62(body)
    assert [s[1] for s in secrets.find_secrets(f"x {good} y")] == [3]
    assert secrets.find_secrets(f"x ghp_{body}zzzzzz y") == []


def test_scan_secrets_cases(spark):
    got = {(r.doc_id, len(r.spans)) for r in secrets.scan_secrets(documents(spark, AWKWARD)).collect()}
    assert (1, 0) in got and (2, 0) in got and (None, 0) in got
    assert secrets.scan_secrets(documents(spark, [])).count() == 0


def plain_pii(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_pii_spans_match_plain_search():
    pieces = ["@", "a", "b.c", ".", "é", " ", "-", "1", "22", "300", "10.0.0.1", "4111111111111111", "+1 (555) 010-9999", "+", "%",
              "x@y.zz", "\n", "١"]
    for text in scattered(pieces, 5, 1500):
        assert pii.base_spans(text) == plain_pii(text)


def test_field_finds_a_repeated_number_without_its_prefix(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        number = f"({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
        again = f" {number} " if i % 3 == 0 else " "
        rows.append((i, f"{prose(i, 12)} +1 {number} {prose(i + 1, 8)}{again}{prose(i + 2, 5)} {rng.randint(1, 10**5)} {prose(i + 3, 4)}"))
    found = {r.doc_id: r.spans for r in pii.scan_pii(documents(spark, rows + [(400 + n, t) for n, (_, t) in enumerate(AWKWARD)])).collect()}
    for i, text in rows:
        assert [(s.start, pii.KINDS.index(s.kind), s.end) for s in found[i] if s.base] == plain_pii(text)
    assert found[400] == [] and found[401] == []


def test_redaction_keeps_the_rest(spark):
    rows = [(1, "mail a.b@c.de now"), (2, None), (3, "no data"), (4, "ip 10.0.0.1, +1 (555) 010-9999.")]
    out = pii.redact(documents(spark, rows))
    assert out.columns == documents(spark, rows).columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "mail [EMAIL] now", 2: None, 3: "no data", 4: "ip [IP], [PHONE]."}
