"""Labelled lines for training the secret tagger, made by rule: where secrets stand, and what only looks like one."""

from __future__ import annotations

import random
import string

# Published prefixes of credentials, and words near them.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "glpat-", "sk_live_", "sk_test_", "pk_live_", "xoxb-", "xoxp-", "AIza", "eyJ", "npm_", "SG.", "hf_", "dop_v1_", "shpat_")
STRONG = ("password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "bearer", "authorization", "credential", "credentials",
          "client_secret", "secret_key", "secret_access_key", "aws_secret_access_key", "access_token", "auth_token", "refresh_token", "private_key", "db_password",
          "signing_key", "encryption_key", "access_key", "session_token", "x-api-key", "webhook_secret")
WEAK = ("key", "auth", "login", "pass", "user", "private", "access", "rsa", "openssh")
PLAIN = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "uuid", "guid", "id", "isbn", "doi", "version", "build", "order", "invoice", "phone", "date", "serial")

_ALNUM = string.ascii_letters + string.digits
_B64 = _ALNUM + "+/"


def _word(r: random.Random) -> str:
    parts = ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de",
             "rt", "ve", "sch", "ung", "eux", "ción", "é", "ñ", "ß", "ü")
    return "".join(r.choice(parts) for _ in range(r.randint(1, 5)))


def _prose(r: random.Random, n: int) -> str:
    words = [_word(r) for _ in range(n)]
    style = r.random()
    if style < 0.12:
        words = [w.upper() + "!!" for w in words]
    elif style < 0.24:
        words = [w + r.choice(("***", "&&&", "%%%", "$$$", "###")) for w in words]
    elif style < 0.32:
        return " | ".join(words)
    out = " ".join(w.capitalize() if r.random() < 0.15 else w for w in words)
    return out + r.choice((".", ",", "", ";"))


def _of(r: random.Random, letters: str, lo: int, hi: int) -> str:
    return "".join(r.choice(letters) for _ in range(r.randint(lo, hi)))


def _value(r: random.Random) -> str:
    kind = r.randrange(8)
    if kind == 0:
        return _of(r, "0123456789abcdef", 24, 64)
    if kind == 1:
        return _of(r, _B64, 24, 64)
    if kind == 2:
        return r.choice(PREFIXES) + _of(r, _ALNUM, 16, 40)
    if kind == 3:
        return "eyJ" + ".".join(_of(r, _ALNUM + "_-", 16, 40) for _ in range(3))
    if kind == 4:
        return _of(r, _ALNUM + "_-", 20, 44)
    if kind == 5:
        return r.choice(("AKIA", "ASIA")) + _of(r, string.ascii_uppercase + string.digits, 16, 16)
    return _of(r, _ALNUM, 10, 20)


def _harmless(r: random.Random) -> str:
    digits = string.digits
    return r.choice((
        lambda: f"{_word(r)}.{_of(r, digits, 1, 3)}@mail{r.randint(1, 9)}.example.{r.choice(('com', 'org'))}",
        lambda: f"+{r.randint(1, 49)} ({_of(r, digits, 3, 3)}) 555-{_of(r, digits, 4, 4)}",
        lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        lambda: f"https://{_word(r)}.example.com/{_word(r)}/{_of(r, digits, 1, 6)}?page={r.randint(1, 99)}&ref={_word(r)}",
        lambda: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}T{r.randint(0, 23):02d}:{r.randint(0, 59):02d}:00Z",
        lambda: f"{r.choice(PLAIN)} {'-'.join(_of(r, '0123456789abcdef', n, n) for n in (8, 4, 4, 4, 12))}",
        lambda: f"version {r.randint(0, 9)}.{r.randint(0, 30)}.{r.randint(0, 99)}-rc{r.randint(1, 9)}",
        lambda: f"{r.choice(STRONG)} {r.choice(('is required', 'must be set', 'was reset', 'of ' + _word(r), 'and ' + _word(r)))}",
        lambda: f"{_word(r)}{_word(r).capitalize()}{_word(r).capitalize()}({_word(r)}_{_word(r)})",
        lambda: "".join(_word(r) for _ in range(r.randint(3, 7))),
        lambda: f"{r.choice(('key', 'user', 'name', 'id', 'order'))}: {_word(r)}{r.choice(('', str(r.randint(1, 99))))}",
        lambda: f"src/{_word(r)}/{_word(r)}_{_word(r)}.py:{r.randint(1, 900)}",
        lambda: _of(r, digits, 4, 15),
        lambda: f"{r.choice(PLAIN)} {_of(r, digits + 'ABCDEF', 6, 12)}",
    ))()


def line(r: random.Random) -> tuple[str, list[tuple[int, int]]]:
    """A line and its secrets (character ranges)."""
    text, spans = _prose(r, r.randint(0, 8)), []

    def add(before: str, secret: str, after: str) -> None:
        nonlocal text
        text += (" " if text else "") + before
        spans.append((len(text), len(text) + len(secret)))
        text += secret + after

    for _ in range(r.choice((0, 0, 1, 1, 2))):
        text += (" " if text else "") + _harmless(r)
    kind = r.random()
    if kind < 0.35:
        name, quote = r.choice(STRONG), r.choice(('"', "'", "", "", "`"))
        name = name.upper() if r.random() < 0.2 else name
        add(name + r.choice((" = ", "=", ": ", ":", " is ", " := ", " => ")) + quote, _value(r), quote)
    elif kind < 0.42:
        add("Authorization: Bearer ", _value(r), "")
    elif kind < 0.50:
        add(f"{r.choice(('postgres', 'mysql', 'amqp', 'https'))}://{_word(r)}:", _of(r, _ALNUM, 8, 18), f"@{_word(r)}.example.com:{r.randint(80, 9999)}/{_word(r)}")
    elif kind < 0.56:
        body = " ".join(_of(r, _B64, 60, 64) for _ in range(r.randint(2, 5)))
        add("-----BEGIN " + r.choice(("RSA ", "EC ", "")) + "PRIVATE KEY----- ", body, " -----END PRIVATE KEY-----")
    elif kind < 0.64:
        add("", r.choice(PREFIXES[:-1]) + _of(r, _ALNUM, 20, 40), "")
    if r.random() < 0.6:
        text += " " + _prose(r, r.randint(1, 8))
    return text, spans


def lines(n: int, seed: int = 5) -> list[tuple[str, list[tuple[int, int]]]]:
    r = random.Random(seed)
    return [line(r) for _ in range(n)]
