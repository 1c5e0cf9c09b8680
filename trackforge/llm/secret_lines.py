"""Labelled lines for the field of ``secrets``, made by rule, and its fit.

``python -m trackforge.llm.secret_lines`` fits the field and writes
secret_field.json; a test checks that the file is what the fit gives.
"""

from __future__ import annotations

import json
import random
import string
from collections.abc import Iterable
from pathlib import Path

import numpy as np
import pyarrow as pa

from trackforge.llm.common import utf8
from trackforge.llm.secrets import _FILE, BEGIN, INSIDE, OUTSIDE, TABLES, Field, Shapes, features

Line = tuple[str, list[tuple[int, int]]]
_LOW, _HIGH, _DIGIT = string.ascii_lowercase, string.ascii_uppercase, string.digits
_SYLLABLES = (
    "the re on ti er sha in le ou es que ion ar mo st nd th ble ly wh and of", "der sch ein lich ung keit für über er en ge ver ß nicht au", "la cion que os a ñ ó de el en as ir", "é è ê ç eau ment oi le de ou an tion",
    "thhst ndst rst ght sts thr nths", "ka to mi no ra su",
)
_COMMON = """the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then
she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know
guide manual release install server update user account service bearing garden ring gratitude history museum station report market river song album artist track length minutes""".split()


def labelled_lines(n: int = 3000, seed: int = 7) -> list[Line]:
    """Texts of a few lines: with secrets, and with what only looks like one."""
    r = random.Random(seed)
    take = lambda chars, k: "".join(r.choice(chars) for _ in range(k))

    def word() -> str:
        w = r.choice(_COMMON) if r.random() < 0.5 else "".join(r.choice(r.choice(_SYLLABLES).split()) for _ in range(r.randint(1, 5)))
        return w.capitalize() if r.random() < 0.12 else w.upper() if r.random() < 0.02 else w

    def prose(k: int) -> str:
        return " ".join(word() + (r.choice(("", "", "", "", "", ",", ".", ";", "!", "?", "...", "***", "%%%", "###", "&&&", "$$$")) if r.random() < 0.3 else "") for _ in range(k))

    def shouted(k: int) -> str:
        mark = r.choice(("", "!", "!!", "***"))
        return " ".join(word().upper() + (r.choice(("", ".", ",")) if r.random() < 0.2 else "") + mark for _ in range(k))

    def camel(k: int) -> str:
        return "".join(w.capitalize() if i else w.lower() for i, w in enumerate(r.choice(_COMMON) for _ in range(k)))

    base64url = _LOW + _HIGH + _DIGIT + "-_"
    leet = lambda: "".join({"o": "0", "a": "4", "e": "3", "i": "1", "s": "5"}.get(c, c) if r.random() < 0.7 else c for c in r.choice(_COMMON) + r.choice(_COMMON))
    strong = (  # secrets wherever they stand
        lambda: r.choice(("ghp_", "gho_", "sk-", "sk_live_", "xoxb-", "pk_live_", "AKIA", "glpat-", "npm_", "hf_", "SG.")) + take(_HIGH + _LOW + _DIGIT, r.randint(18, 40)),
        lambda: "eyJ" + take(base64url, r.randint(12, 40)) + "." + "eyJ" + take(base64url, r.randint(12, 80)) + "." + take(base64url, r.randint(20, 60)),
        lambda: take(_LOW + _HIGH + _DIGIT + "+/", r.randint(32, 88)) + r.choice(("", "=", "==")),
        lambda: r.choice(("MII", "LS0t")) + take(_LOW + _HIGH + _DIGIT + "+/", r.randint(20, 61)),
        lambda: take(_LOW + _HIGH + _DIGIT, r.randint(28, 48)),
        lambda: take(_LOW + _HIGH, r.randint(22, 40)),
    )
    weak = (  # secrets where they are announced
        *strong,
        lambda: take("0123456789abcdef", r.choice((16, 24, 32, 40, 64))),
        lambda: take(_LOW + _HIGH + _DIGIT, r.randint(12, 24)),
        lambda: take(_LOW + _HIGH, r.randint(12, 24)),
        lambda: take(_LOW + _HIGH, 5) + r.choice("!#$%&") + take(_DIGIT, 3) + r.choice("!#$%^") + take(_LOW + _DIGIT, 4),
        lambda: leet().capitalize() + r.choice("!&#$%") + take(_DIGIT, r.randint(1, 3)),
        lambda: r.choice(_COMMON).capitalize() + take(_DIGIT, r.randint(1, 4)) + r.choice("!#$%&"),
        lambda: take(_LOW, 6) + take(_DIGIT, 3),
        lambda: take(_LOW + _DIGIT, r.randint(8, 20)) + take(_DIGIT, 2),
        lambda: "-".join(take("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)),
        lambda: "-".join(take(_HIGH + _DIGIT, 5) for _ in range(r.randint(3, 5))),
        lambda: " ".join(take(_HIGH, 1) + take(_HIGH + _DIGIT, 2) + take(_DIGIT, 1) for _ in range(r.randint(3, 5))),
    )
    phrases = (lambda: "".join(r.choice(_COMMON) for _ in range(r.randint(4, 6))),)  # only told in so many words
    names = (
        "password", "passwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "private_key", "client_secret", "auth_token", "credential", "passphrase", "DB_PASSWORD", "SECRET_KEY", "accessToken", "apiKey",
        "refresh_token", "bearer", "pwd", "x-api-key", "secretAccessKey", "AWS_SECRET_ACCESS_KEY", "credentials", "passcode", "signing_key", "login_pw", "hmac_salt", "encryption_key",
    )
    said = ("password", "passphrase", "secret", "token", "api key", "access key", "private key", "passcode", "pw", "bearer token", "secret key", "client secret", "credential", "login code", "pwd", "auth token")
    signs = (
        '{k} = "{s}"', "{k}={s}", "{k}: {s}", '"{k}": "{s}",', "export {K}={s}", "{k} := '{s}'", "--{k} {s}", "--{k}={s}", "{k}\t{s}", "<{k}>{s}</{k}>", "{k} => '{s}',", "curl -H '{k}: {s}' https://api.example.com/v2",
        'set("{k}", "{s}")', "const {k} = `{s}`;", "{K}: {s} # {w}", "| {k} | {s} |", "{k}({s})", "?{k}={s}&page=2", "{k} is set to {s}",
    )
    spoken = (
        "my {k} is {s}", "{k} {s}", "the {k} for it: {s}", "Authorization: Bearer {s}", "Authorization: Basic {s}", "use {s} as {k} 2", "use {s} as {k}", "the {k} for the {w} is {s}", "{k} you need for the {w} {w} is {s}", "{k} is {s}",
        "user {w} {k} {s}", "{s} is the {k}", "please log in with {s} ({k})", "{k} -> {s}", "new {k}: {s} and do not share it", "your {k} was reset to {s}", "{w}, {k} was: {s}", "{k} for {w} equals {s}", "the {k} ({s}) {w}", "{k} of {w} {w} {w} is now {s}",
    )
    told = ("the {k} for {w} is {s}", "{k} is {s}", "my {k}: {s}", "{k} you need for the {w} is {s}", "{k}: {s}")
    links = ("postgres://{w}:{s}@{w}.example.com/db", "https://{w}:{s}@example.org/{w}.git", "redis://:{s}@localhost:6379/0")
    harmless = (
        lambda: f"+{take(_DIGIT, 2)} {take(_DIGIT, 3)} {take(_DIGIT, 7)}", lambda: f"{word()}.{take(_DIGIT, 2)}@mail.example.com", lambda: f"contact {word()}@{word()}.org now",
        lambda: f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}T{r.randint(0, 23):02}:{take('012345', 2)}:00Z", lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        lambda: f"version {r.randint(1, 9)}.{r.randint(0, 30)}.{r.randint(0, 9)}-rc{r.randint(1, 9)}", lambda: f"http://{word()}.example.org/en/{take(_DIGIT, 5)}?page={r.randint(1, 9)}",
        lambda: f"https://www.{word().lower()}.com/watch?v={take(_LOW + _HIGH + _DIGIT, 11)}", lambda: f"{take(_DIGIT, 4)} {take(_DIGIT, 4)} {take(_DIGIT, 4)} {take(_DIGIT, 4)}", lambda: f"{word()}{r.randint(1, 99)}",
        lambda: f"chapter {r.randint(1, 60)}, page {r.randint(1, 900)}", lambda: f"{word()}_{take(_DIGIT, 4)}.jpg", lambda: f"DE{take(_DIGIT, 20)}", lambda: f"({take(_DIGIT, 3)}) {take(_DIGIT, 3)}-{take(_DIGIT, 4)}",
        lambda: f"{take(_DIGIT, 3)}-{take(_DIGIT, 2)}-{take(_DIGIT, 4)}", lambda: f"{r.randint(1, 999)},{take(_DIGIT, 3)} {word()}", lambda: f"id {take(_DIGIT, r.randint(3, 12))}", lambda: f"x{take(_DIGIT, 2)}_64 utf-8 int32 sha256 md5 base64",
        lambda: f"the {r.choice(said)} of {prose(4)}", lambda: f"a {r.choice(said)} must not be {prose(3)}", lambda: f"{r.choice(names)}: {prose(5)}", lambda: f"copyright (c) {r.randint(1990, 2030)} {word()}",
        lambda: f"{r.choice(said)} is {r.choice(('required', 'missing', 'wrong', 'optional', 'not set', 'expired', 'too short', 'null', 'stored safely', 'empty'))}", lambda: f"forgot your {r.choice(said)}? {prose(3)}",
        lambda: f"{r.choice(names)} = {r.choice(('None', 'null', 'true', 'getpass()', 'os.environ[0]', 'config.value', 'self.value', 'args.' + word(), camel(2) + '()', 'int', 'str', 'string', 'Optional[str]', 'undefined'))}",
        lambda: f"{r.choice(names)}={r.choice(('********', '<your value>', '${VALUE}', '{value}', 'xxxx', '...'))}", lambda: f"order no. {take(_HIGH, 2)}{take(_DIGIT, 8)}", lambda: f"serial {take(_HIGH + _DIGIT, 10)}",
        lambda: f"commit {take('0123456789abcdef', r.choice((7, 12, 40)))}", lambda: f"uuid {'-'.join(take('0123456789abcdef', k) for k in (8, 4, 4, 4, 12))}", lambda: f"ISBN 978-{take(_DIGIT, 1)}-{take(_DIGIT, 4)}-{take(_DIGIT, 3)}-{take(_DIGIT, 1)}",
        lambda: f"{camel(r.randint(2, 4))}({camel(2)}, {r.randint(0, 99)})", lambda: "_".join(r.choice(_COMMON) for _ in range(3)), lambda: "-".join(r.choice(_COMMON) for _ in range(r.randint(2, 4))), lambda: f"{camel(3)}{r.randint(1, 9)}",
        lambda: f"{r.randint(100, 4000)}x{r.randint(100, 4000)}", lambda: f"${r.randint(1, 999)}.{take(_DIGIT, 2)}", lambda: f"#{word()} @{word()}{take(_DIGIT, 2)}", lambda: f"H{r.randint(2, 9)}O, MP3, 4K, 3D, B2B, Q{r.randint(1, 4)}, W{r.randint(1, 52)}",
        lambda: f"ssh-rsa {'A' * 4}B3NzaC1yc2E {word()}@host", lambda: f"tracking number {take(_DIGIT, 12)}", lambda: f"flight {take(_HIGH, 2)}{take(_DIGIT, 4)} gate {take(_HIGH, 1)}{take(_DIGIT, 2)}", lambda: f"/{word()}/{word()}/{word()}{take(_DIGIT, 2)}.py",
        lambda: f"[{take(_DIGIT, 2)}:{take(_DIGIT, 2)}] {word()}: {prose(3)}", lambda: f"key: {word()}", lambda: f"code {take(_DIGIT, 4)}", lambda: f"the {r.choice(said)} {prose(2)} {take(_DIGIT, 2)} {prose(2)}", lambda: f"secret {word()} number {take(_DIGIT, 3)}",
        lambda: "".join(r.choice("thrstnd") for _ in range(r.randint(6, 12))) + r.choice(_COMMON), lambda: f"{word()}/{word()}-{r.randint(1, 99)}.{take(_LOW, 3)}", lambda: f"import {word().lower()}.{camel(2)} as {word().lower()}",
        lambda: f"{r.choice(said)} {prose(6)}", lambda: shouted(r.randint(4, 14)), lambda: f"{r.choice(said).upper()} {shouted(4)}", lambda: f"{word()} is is {word()}{word()}{word()}",
        lambda: f"{r.choice(('IMG', 'DSC', 'VID', 'scan', 'PXL'))}_20{take(_DIGIT, 6)}_{take(_DIGIT, 6)}.{r.choice(('jpg', 'mp4', 'png', 'pdf', 'log'))}", lambda: f"{r.choice(names)} = {word().lower()}.{camel(2)}('{r.choice(said).capitalize()}: ')",
        lambda: f"public {camel(1)} get{camel(2).capitalize()}{r.choice(('Token', 'Secret', 'Password', 'Key'))}{r.choice(('', 'From', 'By'))}{camel(2).capitalize()}({camel(2)} {camel(2)}, {camel(3)} {camel(3)})", lambda: f"{camel(4)}.{camel(5)}.{camel(3)}()", lambda: f"if not {r.choice(names)}: raise ValueError('{r.choice(names)} {word()}')", lambda: "=" * r.randint(3, 40), lambda: f"AT&T R&D {word()}&{word()} C# C++ {r.randint(1, 99)}% {word()}!",
    )
    out: list[Line] = []
    for _ in range(n):
        code = r.random() < 0.4
        filler = (lambda: f"{camel(2)} = {word()}({camel(2)});\n") if code else (lambda: (prose if r.random() < 0.93 else shouted)(r.randint(3, 12)) + r.choice((". ", ", ", "\n", " ", ": ")))
        text, spans = filler() if r.random() < 0.8 else "", []
        for _ in range(r.randint(1, 4)):
            chance = r.random()
            if chance < 0.42:
                name, template, secret = r.choice(names), r.choice(signs), r.choice(weak)()
                if chance < 0.03:
                    template = r.choice(links)
                    secret = take(_LOW + _HIGH + _DIGIT, r.randint(8, 24))
                elif chance < 0.07:
                    name, template, secret = r.choice(said), r.choice(told), r.choice(phrases)()
                elif chance < 0.1:
                    template, secret = r.choice(("{s}", "{w} {s}", "{s}\n", "{w}: {s}", "'{s}'", "{w} {w} {s} {w}")), r.choice(strong)()
                elif not code and r.random() < 0.6:
                    name, template = r.choice(said), r.choice(spoken)
                if "Bearer" in template or "Basic" in template:
                    secret = r.choice(strong)()
                before, after = (x.format(k=name, K=name.upper(), w=word()) for x in template.replace("{s}", "\0", 1).replace("{s}", "").split("\0"))
                own = (len(text) + len(before), len(text) + len(before) + len(secret))
                spans.append(own)
                text += before + secret + after + r.choice((" ", "\n", ". ", ", "))
            else:
                text += r.choice(harmless)() + r.choice((" ", ". ", "### ", "\n", ", "))
            text += filler()
        for _ in range(r.choice((0, 0, 0, 6))):  # some long ones
            text += filler() + "\n"
        out.append((text, spans))
    return out


def fit(lines: Iterable[Line], steps: int = 130, rate: float = 0.1, decay: float = 2e-4) -> Field:
    """Maximum likelihood (Adam, L2) on texts with the spans of their secrets."""
    lines = list(lines)
    data, offsets = utf8(pa.array([t for t, _ in lines]))
    tokens = features(data, offsets, Shapes())
    gold, row = np.zeros(len(tokens.row), np.int64), tokens.row
    first_of = np.searchsorted(row, np.arange(len(lines) + 1))
    for i, (text, spans) in enumerate(lines):
        at = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])]) + offsets[i]
        for a, b in spans:
            own = np.flatnonzero((tokens.starts[first_of[i] : first_of[i + 1]] < at[b]) & (tokens.ends[first_of[i] : first_of[i + 1]] > at[a])) + first_of[i]
            gold[own] = INSIDE
            gold[own[:1]] = BEGIN
    # chains of equal length together, each padded to its batch
    _, starts, counts = np.unique(tokens.line, return_index=True, return_counts=True)
    order = np.argsort(counts, kind="stable")
    batches = [(starts[b], counts[b]) for b in np.array_split(order, 12) if len(b)]
    n = len(starts)
    w, moves = np.zeros((sum(TABLES), 3)), np.zeros((3, 3))
    moves[OUTSIDE, INSIDE] = -8.0
    state = [np.zeros_like(x) for x in (w, w, moves, moves)]
    lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
    one = np.eye(3)
    for step in range(1, steps + 1):
        every = np.zeros((len(gold), 3))
        for column in tokens.codes.T:
            every += w[column]
        error, gm = np.zeros_like(every), -decay * moves
        for begins, lengths in batches:
            longest = int(lengths.max())
            place = begins[:, None] + np.minimum(np.arange(longest), lengths[:, None] - 1)
            mask = np.arange(longest) < lengths[:, None]
            e, y, k = every[place], gold[place], len(begins)
            forward, backward = np.zeros((k, longest, 3)), np.zeros((k, longest, 3))
            forward[:, 0] = moves[OUTSIDE] + e[:, 0]
            for j in range(1, longest):
                forward[:, j] = np.where(mask[:, j, None], lse(forward[:, j - 1, :, None] + moves, 1) + e[:, j], forward[:, j - 1])
            total = lse(forward[:, -1] + moves[:, OUTSIDE], 1)
            backward[:, -1] = moves[:, OUTSIDE]
            for j in range(longest - 2, -1, -1):
                backward[:, j] = np.where(mask[:, j + 1, None], lse(moves[None] + (e[:, j + 1] + backward[:, j + 1])[:, None, :], 2), backward[:, j + 1])
            seen = np.exp(forward + backward - total[:, None, None])
            error[place[mask]] = (one[y] - seen)[mask]
            gm[OUTSIDE] += (one[y[:, 0]] - seen[:, 0]).sum(0) / n
            end = lengths - 1
            gm[:, OUTSIDE] += (one[y[np.arange(k), end]] - seen[np.arange(k), end]).sum(0) / n
            both = np.exp(forward[:, :-1, :, None] + moves + (e[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]) if longest > 1 else np.zeros((k, 0, 3, 3))
            true = one[y[:, :-1]][..., :, None] * one[y[:, 1:]][..., None, :]
            gm += ((true - both) * mask[:, 1:, None, None]).sum((0, 1)) / n
        gw = -decay * w
        for column in tokens.codes.T:
            for x in range(3):
                gw[:, x] += np.bincount(column, error[:, x], len(w)) / n
        for x, g, (m, v) in ((w, gw, state[:2]), (moves, gm, state[2:])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w[np.abs(w).max(1) < 0.01] = 0
    return Field(np.round(w, 3), np.round(moves, 3))


def write(field: Field, path: Path = _FILE) -> None:
    used = np.flatnonzero(field.weights.any(1))
    rows = ",\n".join(json.dumps([int(i), *map(float, field.weights[i])]) for i in used)
    path.write_text(f'{{"moves": {json.dumps(field.moves.tolist())},\n"weights": [\n{rows}\n]}}\n')


if __name__ == "__main__":
    write(fit(labelled_lines()))
