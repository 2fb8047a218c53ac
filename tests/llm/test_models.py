"""Language ID, secret scan and personal data: gradients, held-out accuracy, and plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import language_id, personal_data, secret_scan
from tests.llm.conftest import passage

SYLLABLES = {
    "aa": "ka ki ko ta ti to ma mi mo ra ri ro",
    "bb": "sch ein ung ver lich ber auf ent",
    "cc": "ção é ñe lla ué ía rro que",
}


def written_in(rng, language, words):
    parts = SYLLABLES[language].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def speech(spark):
    rng = random.Random(1)
    rows = []
    for i in range(360):
        language = rng.choice(list(SYLLABLES))
        rows.append((i, written_in(rng, language, rng.randint(20, 120)), language))
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !? 456", "cc"), (1003, written_in(rng, "aa", 9000), None), (None, written_in(rng, "bb", 30), "bb")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumns({"row": F.lit(1), "score": F.lit(2), "draw": F.lit(3)})


@pytest.fixture(scope="module")
def network(speech):
    return language_id.fit(speech, ~language_id.held_out())


def test_gradients():
    rng = np.random.default_rng(0)
    network = language_id.Network.new(["a", "b", "c"])
    for w in network._weights():
        w += rng.normal(0, 0.1, w.shape)
    rows = np.ascontiguousarray(rng.integers(97, 105, (5, 9)).astype(np.intp))
    y = rng.integers(0, 3, 5)

    def loss():
        p, _, _ = network.probabilities(rows.T)
        return -np.log(p[:, y, np.arange(5)]).sum(dtype=float)

    traces = ([], [])
    p, ahead, back = network.probabilities(rows.T, traces)
    d = p.copy()
    d[:, y, np.arange(5)] -= 1
    h = language_id.HIDDEN
    found = network.forward.gradients(rows.T, traces[0], np.matmul(network.out[:, :h].T, d))
    found += network.backward.gradients(rows.T[::-1], traces[1], np.matmul(network.out[:, h : 2 * h].T, d)[::-1])
    for weight, gradient in zip(network._weights()[:6], found):
        steep = np.argsort(-np.abs(gradient).ravel())[:6]
        for at in steep:
            kept = weight.flat[at]
            weight.flat[at] = kept + 1e-2
            up = loss()
            weight.flat[at] = kept - 1e-2
            down = loss()
            weight.flat[at] = kept
            assert abs((up - down) / 2e-2 - gradient.flat[at]) < 0.05 * abs(gradient.flat[at]) + 0.02


def test_languages_of_held_out_documents(speech, network):
    found = language_id.identify(speech, network)
    rows = found.select("row.doc_id", "row.lang", "lang_pred", "score", "n_letters", "n_agree", "row.score").collect()
    assert len(rows) == 365 and network.languages == ["aa", "bb", "cc"]
    by_id = {r[0]: r for r in rows}
    for unknown in (1000, 1001, 1002):
        assert by_id[unknown][2:4] == ("und", 0.0)
    assert by_id[1003][2] == "aa" and by_id[None][2] == "bb"
    held = {r[0] for r in speech.where(language_id.held_out()).select("doc_id").collect()}
    tested = [r for r in rows if r[0] in held and r[0] < 1000]
    assert len(tested) > 80 and np.mean([r[1] == r[2] for r in tested]) > 0.97
    assert all(0 <= r[3] <= 1 and r[5] <= r[4] and r[6] == 2 for r in rows)


def test_prediction_does_not_depend_on_neighbours(speech, network):
    alone = {r[0]: r[1] for r in language_id.identify(speech.where("doc_id < 5"), network).select("row.doc_id", "score").collect()}
    among = {r[0]: r[1] for r in language_id.identify(speech, network).select("row.doc_id", "score").collect()}
    assert all(abs(among[i] - s) < 1e-5 for i, s in alone.items())


def test_languages_of_nothing(spark, speech, docs, no_docs):
    empty = speech.limit(0)
    assert language_id.fit(empty, F.lit(True)) is None
    assert language_id.identify(speech, None).where("lang_pred = 'und' and score = 0").count() == 365
    assert language_id.identify(no_docs, None).count() == 0
    one = language_id.fit(speech.where("lang = 'aa'"), F.lit(True))
    assert {r[0] for r in language_id.identify(docs, one).select("lang_pred").collect()} == {"aa", "und"}


def test_the_rule_for_letters():
    assert [language_id.has_letter(t) for t in (None, "", "1 2", "²½", "x", "ß", "日", "_")] == [False, False, False, False, True, True, True, False]


def secret_rows(seed=2):
    rng = random.Random(seed)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows, planted = [], {}
    for i in range(300):
        text = passage(i % 40, 30)
        if i % 3 == 0:
            name = rng.choice(["token", "api_key", "db_password", "client-secret"])
            value = hexes(rng.choice([32, 40]))
            text += f' {name} = "{value}" ' + passage(i, 5)
            planted[i] = value
        elif i % 3 == 1:
            word = passage(i % 40, 30).replace(" ", "")[:24]
            text += f" {word} and 4000{rng.randrange(10**14):014d} see http://x.org/{passage(i % 40, 3).replace(' ', '/')}/index"
        rows.append((i, text))
    return rows, planted


def test_secrets(spark):
    rows, planted = secret_rows()
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, label int, features string")
    found = secret_scan.scan(table, F.col("doc_id") % 5 != 0).collect()
    texts = dict(rows)
    called = {r["doc_id"]: texts[r["doc_id"]][r["start"] : r["end"]] for r in found if r["is_secret"] and r["doc_id"] % 5 == 0}
    assert called == {i: v for i, v in planted.items() if i % 5 == 0}
    tokens = {hashlib.sha256(t.encode()).hexdigest() for x in texts.values() for t in re.findall(r"[A-Za-z0-9+/=_-]{16,}", x)}
    assert {r["token_sha256"] for r in found} == tokens


def test_secrets_of_awkward_texts(docs, no_docs):
    assert secret_scan.scan(no_docs).count() == 0
    found = secret_scan.scan(docs).collect()
    assert any(r["end"] - r["start"] == 60_000 for r in found) and not any(r["is_secret"] for r in found)


def test_forest():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = secret_scan.Forest(x[:400], y[:400])
    assert ((forest.predict(x[400:]) > 0.5) == y[400:]).mean() > 0.85


def test_dictionary_coverage():
    words = frozenset(["abc", "defg", "ab"])
    assert secret_scan.coverage("abcdefg", words) == (1.0, 4)
    assert secret_scan.coverage("1ABCx9zz", words) == (3 / 8, 3)


def plain_spans(text):
    found = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, m.start(), m.end()))
    return found


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(sum(divmod(d, 10)) for d in doubled) % 10 == 0


def test_base_spans():
    rng = random.Random(6)
    parts = ["@", ".", "a", "B.c", "x@y", "1.2.3.4", "256.1.1.1", "+1 ", "(499) 555-6503", "4111111111111111", "4111 1111-1111 1111", " ", "-", "é", "%", "0", "00255", "\n", "٣", "+", "5105105105105100123"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [tuple(s) for s in personal_data.base_spans(text)] == plain_spans(text), text


def test_long_runs_are_quick():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "." * 200_000 + "@", "+1" + " " * 100_000):
        personal_data.instances(text, personal_data.base_spans(text))


def test_contexts_discover_identifiers(spark):
    rng = random.Random(9)
    rows = []
    for i in range(120):
        number = f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}"
        rows.append((i, f"{passage(i, 10)} server {number} answered {passage(i + 7, 8)}"))
    rows += [(200 + i, f"{passage(i, 6)} server 300.{i}.1.7 answered") for i in range(6)]
    rows += [(300 + i, f"{passage(i, 6)} invoice 301.{i}.2.9 paid") for i in range(6)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"number": F.lit(1), "spans": F.lit("s"), "new": F.lit("n")})
    found = {r[0]: r for r in personal_data.personal_data(table).select("row.doc_id", "base", "discovered", "row.spans").collect()}
    assert len(found) == len(rows) and all(r[3] == "s" for r in found.values())
    texts = dict(rows)
    for i, r in found.items():
        own = [(s["kind"], texts[i][s["start"] : s["end"]]) for s in r[2]]
        assert [tuple(s) for s in r[1]] == plain_spans(texts[i])
        assert own == ([("ip", f"300.{i - 200}.1.7")] if 200 <= i < 300 else [])


def test_contexts_discover_all_kinds(spark):
    rng = random.Random(10)

    def card():
        body = f"4{rng.randrange(10**14):014d}"
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))

    seeds = {
        "email": ("write", lambda i: f"{passage(i, 1)}{i}@mail.example", "soon"),
        "ip": ("server", lambda i: f"10.{i}.{rng.randint(0, 255)}.7", "answered"),
        "card": ("card", lambda i: card(), "charged"),
        "phone": ("call", lambda i: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", "now"),
    }
    rows, other = [], iter(range(1000, 2000))
    for left, seed, right in seeds.values():
        rows += [(next(other), f"{passage(i, 9)} {left} {seed(i)} {right} {passage(i + 3, 9)}") for i in range(100)]
    hidden = {
        "email": ["alice@localhost", "bob (at) mail.example", "eve [at] mail [dot] example", "jürgen@müller.de"],
        "ip": ["300.4.1.7", "10-0-0-77x"],
        "card": ["4111 1111 1111 1112", "4111-1111-1111-1113"],
        "phone": ["(743) 555-3824", "030 1234567", "0049/30 77 66 55", "743.555.3824"],
    }
    expected = {}
    for kind, (left, _, right) in seeds.items():
        for value in hidden[kind]:
            # Between both words, and with one of them alone.
            for text in (f"pf {left} {value} {right} pf", f"pf {left} {value}", f"{value} {right} pf"):
                expected[len(expected)] = [(kind, value)]
                rows.append((len(expected) - 1, text))
    for value in ("(743) 555-3824", "alice@localhost", "030 1234567"):
        expected[len(expected)] = []
        rows.append((len(expected) - 1, f"pf invoice {value} paid pf"))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = dict(rows)
    found = {r[0]: r for r in personal_data.personal_data(table).select("row.doc_id", "base", "discovered").collect()}
    for i, known in expected.items():
        assert [(s["kind"], texts[i][s["start"] : s["end"]]) for s in found[i][2]] == known, texts[i]
    for i, r in found.items():
        assert [tuple(s) for s in r[1]] == plain_spans(texts[i])
        spans = sorted((s["start"], s["end"]) for s in [*r[1], *r[2]])
        assert i in expected or not r[2]
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_personal_data_of_awkward_texts(docs, no_docs, texts):
    assert personal_data.personal_data(no_docs).count() == 0
    found = personal_data.personal_data(docs).select("row.doc_id", "base").collect()
    expected = sorted(((i, plain_spans(t or "")) for i, t in texts), key=str)
    assert sorted(((r[0], [tuple(s) for s in r[1]]) for r in found), key=str) == expected
