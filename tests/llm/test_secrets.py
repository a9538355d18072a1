import hashlib
import random
import re

from small import DOCS, awkward_rows, prose

from shiftledger.llm.secrets import digest, find_secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = ("assign", "access", "hex")


def base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(spans)


def rows():
    rng = random.Random(6)
    found = awkward_rows()
    text = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    for i in range(60):
        found.append((100 + i, f"{prose(rng, 20)} Token='{text(40)}' é {prose(rng, 9)} AKIA{text(16).upper()} {text(31) if i < 3 else i} {text(33)}", "", "", 1))
        found.append((300 + i, f"call someOrdinaryIdentifierName and_another_quite_long_name {prose(rng, 5)}", "", "", 1))
    found += [
        (900, "password: token: abcdefgh password=secret=abcdefgh1", "", "", 1), (901, "AKIAAKIA12 AKIA" + "Z" * 12, "", "", 1),
        (902, "api_key =\t'x' apikey=\"12345678\" API_KEY:abcdefgh.", "", "", 1), (903, "a" * 31 + "g" + "a" * 32, "", "", 1),
        (904, "\U0001f600 passwd = 'ABCDEFGHIJ' 𝒳 " + "0" * 64, "", "", 1), (905, f"{prose(rng, 9)} sessionid {text(24)} end", "", "", 1),
        (906, "token=" + "q" * 20_000, "", "", 1), (907, "password=12345678" * 300, "", "", 1),
    ]
    return found


def test_rules_match_a_plain_scan(spark):
    made = rows()
    docs = spark.createDataFrame(made, DOCS)
    found = digest(find_secrets(docs)).collect()
    assert len(found) == len(made)
    want = []
    for i, text, *_ in made:
        spans = base(text or "")
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want.append((i is not None, i or 0, *(sum(k == n for _, k, _ in spans) for n in range(3)), hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found) == sorted(want)


def test_the_models_add_random_strings_only(spark):
    found = {r.doc_id: r.spans for r in digest(find_secrets(spark.createDataFrame(rows(), DOCS))).collect()}
    assert re.search(r"markov:\d+:\d+", found[905])
    assert not any("markov" in found[300 + i] for i in range(60))
    assert not any("markov" in found[i] for i in range(103, 160))


def test_pieces_beside_a_rules_span_are_scored(spark):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    name = lambda: "".join(w.title() for w in prose(rng, 6).split()) + str(rng.randint(0, 99)) + "_of_" + prose(rng, 1)
    made = [(i, f"{prose(rng, 9)} token={text(40)} {name()} {name()} {prose(rng, 9)}") for i in range(600)]
    own = "0123456789abcdef" * 2
    made += [
        (1000, f"hooks/{own}/Zx9Qv7Lr2Kp8Wm4TnB6sYd1 x"), (1001, f"é {text(24)}/{own}/{text(23)}/{own}"),
        (1002, f"some_quite_ordinary_name/{own}/{text(13)}"), (1003, "AKIA" + "Z" * 16 + f"-{text(23)}"),
    ]
    found = {r.doc_id: r.spans for r in digest(find_secrets(spark.createDataFrame(made, "doc_id long, text string"))).collect()}
    assert found[1000] == "hex:6:38,markov:38:62"
    assert found[1001] == "markov:2:27,hex:27:59,markov:59:84,hex:84:116"
    assert found[1002] == "hex:25:57"
    assert found[1003] == "access:0:20,markov:20:44"


def test_without_samples_nothing_is_added(spark):
    docs = spark.createDataFrame([(1, "anOrdinaryIdentifierHere")], "doc_id long, text string")
    assert [r.spans for r in digest(find_secrets(docs)).collect()] == [""]
    assert digest(find_secrets(docs.limit(0))).collect() == []
    clash = spark.createDataFrame([(1, "token=abcdefgh", "x")], "doc_id long, text string, spans string")
    assert [r.spans for r in digest(find_secrets(clash)).collect()] == ["assign:0:14"]
