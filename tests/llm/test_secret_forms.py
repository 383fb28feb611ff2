"""Secret scans: further forms, time on hostile texts, and literals by a second tokenizer."""

import random
import re
import time

import pytest

from dockflow.llm import secret_scan

VALUE = "Zk8Qp2LmX9rT4vB7"
FORMS = [
    "$pwd = '{}';", "$env:DB_PASSWORD = \"{}\"", "my $secret = '{}';", '#define DB_PWD "{}"', '#  define API_TOKEN ("{}")', 'pwd = ("{}")', "password = (\n    '{}'\n)",
    'user, pwd = "administrator1", "{}"', 'name, $token = ("Longer4Name9", "{}")', "pwd: &main {}", "password: !!str '{}'", 'pwd = os.getenv("DB_PASSWORD_NAME", "{}")',
    "token = decrypt('{}')", "base: &b |\n  {}\npwd: $base", "<main>{}</main>\n<password>${main}</password>", "<a/><secret\n>\n{}\n\n</secret>", "value = '{}'\nsecret, n = value, 1",
]


@pytest.mark.parametrize("form", FORMS)
def test_forms(form):
    text = "x = 1\n" + form.replace("{}", VALUE) + "\ny = 2\n"
    assert [text[a:b].strip() for k, a, b in secret_scan.spans(text) if k == "literal"] == [VALUE]


MANY = 100_000
HOSTILE = [
    "a=1 <a>" + " " * MANY + "<b", "<a" + " " * MANY + "<b </", "<a><![CDATA[" * (MANY // 8), "<a>x" * MANY, "<a>" + "]" * MANY, "<secret><![CDATA[]]>" * (MANY // 8),
    "password" + " " * MANY + "x", "password:" + " " * MANY, 'password = "' + "x" * MANY, "password = `" + "${" * MANY + "\nx`", 'a = """' + "\\" * MANY, "a, " * MANY + "=", "a" * MANY + "=",
    "a = '''x\n" * (MANY // 4), "secret: |\n" + "\n" * MANY, "secret: |\n" + "  \n" * MANY + "x", "a = f(" * MANY, "a = (" * MANY, "#define " * MANY, "x = " + "+" * MANY, "$" * MANY + "=",
    "a['b']" * (MANY // 4) + "=", "a:" + "int|" * MANY, "a: x" + "[" * MANY, "&a " * MANY + "a: " + "&a " * MANY, "password=" * (MANY // 4), "<" * MANY + "/", 'a="' * MANY, '<a b="' * MANY + "</",
]


@pytest.mark.parametrize("i", range(len(HOSTILE)))
def test_linear_time(i):
    begun = time.perf_counter()
    secret_scan.spans(HOSTILE[i])
    assert time.perf_counter() - begun < 5  # tenths of a second; what is quadratic takes minutes


def simple_literals(text):
    """Literal spans of lines `name = "literal"`, `name = word` and `name = name`."""
    worth, value, found = {}, {}, []
    for m in re.finditer(r"[^\n]+", text):
        words = m[0].split(" ", 2)
        if len(words) == 3 and words[1] == "=":
            place = m.start() + len(words[0]) + 3
            if words[2][0] in "\"'":
                span = (place + 1, m.end() - 1)
            else:
                span = value.get(words[2], (place, m.end()))
            value[words[0]] = span
            worth.setdefault(span, []).append(secret_scan.sensitivity(words[0]))
    for (a, b), own in worth.items():
        if max(own) and max(own) * secret_scan.look(text[a:b]) >= 0.6:
            found.append((a, b))
    return sorted(found)


def test_literals_by_a_second_tokenizer():
    rng = random.Random(4)
    names = ["password", "colour", "api_key", "x", "dbPassword", "token_count", "home", "auth_token"]
    n = 0
    for _ in range(400):
        lines = []
        for _ in range(rng.randint(1, 8)):
            literal = "".join(rng.choices("abcXYZ0189", k=rng.choice([3, 8, 16])))
            quote = rng.choice(["'", '"', ""])
            lines.append(f"{rng.choice(names)} = {rng.choice([quote + literal + quote, rng.choice(names)])}" if rng.random() < 0.9 else "some words of prose, no more")
        text = "\n".join(lines)
        want = simple_literals(text)
        n += len(want)
        assert [(a, b) for k, a, b in secret_scan.spans(text) if k == "literal"] == want, text
    assert n > 200
