import re

import pytest

from linkscore.llm import secrets as S

NAMES = ["password", "passwd", "secret", "token", "api_key", "apikey"]
EITHER = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in NAMES)


def brute(text):
    found = []
    for kind, pattern, least in (
        (0, rf"""(?:{EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
        (1, r"(AKIA[A-Z0-9]+)", 18),
        (2, r"([0-9a-f]+)", 16),
    ):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[1]) >= least]
    return sorted(found)


TEXTS = [
    "", "token = 'abcdefghijkl'", "TOKEN=abc", "ſecret=abcdefghijkl toKen=abcdefghijkl", "secret: password=abcdefghijklmno",
    "token=token=abcdefghijkl", "api_key  :  abcdefghijkl+/=", "x" * 10 + "0123456789abcdef0", "é AKIA" + "A1" * 8, "AKIA" + "A" * 13,
    "AKIAAKIA" + "B" * 13, "password\n=\nabcdefghijklmn", "passwordpassword=aaaaaaaaaaaa", "deadbeef" * 8, "a" * 200_000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_patterns_equal_brute_force(text):
    assert S.base_spans(text) == brute(text)


def literals(text):
    return [text[a:b] for a, _, b in S.literal_spans(text)]


def test_literals_by_the_names_they_reach():
    assert literals('DB_KEY = "q8Zr5T0pLm3X"\nconnect(user="bob", password=DB_KEY)') == ["q8Zr5T0pLm3X"]
    assert literals('{"name": "hello world", "clientSecret": "aB3$kd92kdLs0"}') == ["aB3$kd92kdLs0"]
    assert literals("export API_TOKEN=9f8a7s6d5f4g3h2j") == ["9f8a7s6d5f4g3h2j"]
    assert literals('a = "q8Zr5T0p"\nb = a + "Lm3X77Kq"\nauth_token = b') == ["q8Zr5T0p", "Lm3X77Kq"]
    assert literals("spring.datasource.password: q8Zr5T0pLm3X") == ["q8Zr5T0pLm3X"]
    assert literals("Authorization: Bearer q8Zr5T0pLm3X9w") == ["q8Zr5T0pLm3X9w"]


@pytest.mark.parametrize("text", [
    'title = "q8Zr5T0pLm3X"', 'password = "changeme_please1"', 'password = "${DB_PASSWORD_1}"', "The token: it was lost.", 'secret = "short"',
    "a = b\nb = a\npassword = a", "== password", "password",
])
def test_no_literal(text):
    assert literals(text) == []


MANY_NAMES = "\n".join(f"n{k} = n{k + 1}" for k in range(200_000)) + '\npassword = n0\nn200000 = "q8Zr5T0pLm3X"'


def test_a_long_chain_of_names():
    assert literals(MANY_NAMES) == ["q8Zr5T0pLm3X"]


#: Texts, and whether they hold a secret literal.
LABELLED = [
    ('db_password = "q8Zr5T0pLm3X"', True),
    ('const apiKey = `9f8a7s6d5f4g3h2j`;', True),
    ('{"client_secret": "aB3$kd92kdLs0"}', True),
    ("AUTH_TOKEN=zX81kQp0vN4m", True),
    ("secret: 7hK2mPq9Lx4R", True),
    ('K = "q8Zr5T0pLm3X"\nlogin(password=K)', True),
    ("signing_secret => 'Qw3rTy7uIo9p'", True),
    ("token: refreshTokenHandler", False),
    ("password = getpass.getpass('Password: ')", False),
    ("password = read_password(prompt2)", False),
    ("token = request.headers.authorization", False),
    ("secret: loadFromEnvironment", False),
    ("apiKey = os.environ.get(name)", False),
    ("passwd: ${DATABASE_PASSWORD1}", False),
    ('title = "q8Zr5T0pLm3X"', False),
    ("The password: nobody remembered it.", False),
    ("auth = BasicAuthentication", False),
]


def test_precision_and_recall_of_literals():
    found = [bool(literals(text)) for text, _ in LABELLED]
    right = sum(f and wanted for f, (_, wanted) in zip(found, LABELLED))
    assert right / sum(found) >= 0.95 and right / sum(wanted for _, wanted in LABELLED) >= 0.95


def test_time_is_linear():
    for text in ("a" * 300_000, "password " * 40_000, 'token="' * 40_000, "x = y + " * 40_000, "a_" * 150_000, MANY_NAMES):
        S.base_spans(text)
        S.literal_spans(text)


def test_table(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(TEXTS)] + [(None, None, None, None), (0, "", "x", 1), (99, 'password = "q8Zr5T0pLm3X"', "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_hex int")
    out = S.find_secrets(df).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] not in (None, 0, 99):
            found = brute(TEXTS[r["doc_id"]])
            assert r["base_spans"] == S._joined(found)
            assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == k for x in found) for k in range(3)]
        assert set(filter(None, r["base_spans"].split(","))) <= set(r["spans"].split(","))
    last = next(r for r in out if r["doc_id"] == 99)
    assert last["spans"] == "assign:0:24,literal:12:24" and last["n_literal"] == 1
    assert S.find_secrets(df.limit(0)).collect() == []


def test_every_sensitive_name_passes_the_prefilter(spark):
    names = ["api_access", "apiAccess", "api-access", "pass_word", "to_ken", "toKen", "sec__ret", "title", *S.SENSITIVE]
    texts = [f'{n} = "q8Zr5T0pLm3X"' for n in names]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: r["n_literal"] for r in S.find_secrets(df).collect()}
    assert found == {k: len(S.literal_spans(t)) for k, t in enumerate(texts)} and sum(found.values()) >= 7
