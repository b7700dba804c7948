"""Added kinds have no upper length, and their spans and verdicts are those of a plain scan."""

import random
import re
from collections import defaultdict

from tests.conftest import MEDIUM
from txnrisk.llm import secrets
from txnrisk.llm.registry import op6_secret_scans

PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "web_token": r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "issued": r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|AIza[0-9A-Za-z_-]{35})",
    "login": r"://[^\s:/@]+:[^\s:/@]{6,}@",
}
KINDS = list(PATTERNS)


def plain(docs):
    """All spans of (id, text, source, lang), with what the ownership of their values makes of them."""
    found, owners, places = defaultdict(list), defaultdict(set), defaultdict(set)
    for row, (_, text, source, lang) in enumerate(docs):
        for rank, (kind, pattern) in enumerate(PATTERNS.items()):
            for match in re.finditer(pattern, text or "", re.ASCII):
                value = match.group(2 if kind == "assign" else 0)
                if kind == "assign" and len(value) < 6:
                    continue
                found[row].append((match.start(), rank, match.end(), value))
                owners[value].add(source or "")
                places[value].add((source, lang))
    rows = []
    for row, (doc, *_) in enumerate(docs):
        spans = []
        for start, rank, end, value in sorted(found[row]):
            example = len(owners[value]) >= 3 or len(places[value]) >= 5
            if rank < 3 or not example:
                spans.append(f"{KINDS[rank]}:{start}:{end}")
        rows.append((doc, ",".join(spans)))
    return rows


def test_all_kinds_against_a_plain_scan(spark):
    rnd = random.Random(8)
    values = [
        "postgres://" + "u" * 70 + ":" + "p" * 200 + "@db",
        "x://user:" + "q" * 6 + "@h",
        "-----BEGIN " + "VERY " * 10 + "PRIVATE KEY-----",
        "-----BEGIN RSA PRIVATE KEY-----",
        "eyJ" + "a" * 500 + "." + "b" * 500 + "." + "c" * 500,
        "ghp_" + "Z" * 90,
        "password = '" + "s3cret" * 40 + "'",
        "AKIA" + "Q" * 64,
        "0f" * 300,
    ]
    docs = []
    for i in range(400):
        body = " ".join(rnd.choice(values) + rnd.choice(["", str(i), str(i % 7)]) if rnd.random() < 0.3 else "wörd" for _ in range(12))
        docs.append((i, body, f"src{rnd.randrange(6)}", rnd.choice(["en", "de", None])))
    docs += [(900, None, None, None), (901, "", "src1", "en"), (902, "none here", None, "en")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").repartition(4)
    found = secrets.summary(secrets.scan(frame)).select("doc_id", "spans").collect()
    assert sorted(map(tuple, found)) == sorted(plain(docs))


def test_given_documents_against_a_plain_scan(spark, medium):
    docs = [(r.doc_id, r.text, r.source, r.lang) for r in medium.collect()]
    found = op6_secret_scans(spark, MEDIUM).select("doc_id", "spans").collect()
    assert sorted(map(tuple, found)) == sorted(plain(docs))
