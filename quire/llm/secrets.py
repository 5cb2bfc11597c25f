"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are long runs of key characters that hold a digit, each with the word before it. The
forest sees a candidate's length, its character classes, how likely its transitions from character to character are in
secrets against other runs (a table learned from the same findings), how much of it dictionary
words cover, the path, and the word before. It is trained from labelled findings (text of
the candidate, word before, separator, path, whether it is a secret) and compiled to nested CASE
expressions, so scanning is one projection of SQL functions, without Python and without a shuffle; the
same expressions are the DuckDB oracle. More candidates, of any length and with or without a digit, are what follows a
secret word and what begins with a known prefix; a second forest, which has learned short ones too, votes on those, and the oracle
is held without them. Private key blocks are found whole, from BEGIN through END; one without an end through its last line of key
characters. (The oracle has the BEGIN lines.)

Defined results: a null or empty text has no candidates; a repeated secret is a finding each time; a null
path is empty; repeated rows each get their own row; extra columns are not read.
"""

from __future__ import annotations

import math
import random
import re
import string

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups: word before, separator, candidate. The separator holds no key character.
PATTERN = r"""(?:([A-Za-z_]{1,32})(["']?[ \t]{0,3}[=:][ \t]{0,3}["']?|[ \t\n"'(]{1,3}))?([A-Za-z0-9+/_-]{16,}={0,2})"""
#: The candidate alone.
RUN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
BLOCK = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
#: A whole block; its body holds no five hyphens. Without an end: the headers and the lines of key characters that follow.
KEY = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----(?:[^-]*+(?:-{1,4}+[^-]++)*+-----END [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----|(?:\s*+[A-Z][A-Za-z-]{1,20}: [^\n]*+)*+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{40,}+={0,2}+)++(?:\r?\n[A-Za-z0-9+/]{1,63}+={0,2}+(?=[ \t\r]*+(?:\n|$)))?)?"
# Words of keys, of names and placeholders, and of other long runs.
DICTIONARY = "|".join(
    """
    password secret token service account example version default private public document settings response request session message language library
    resource template position database directory property function argument parameter variable reference container component interface character number
    string object module package project product customer country address history system server client source target result content display element report
    review release update delete create insert select filter format header footer button layout style theme image index table column value field label
    title group order event action handler method class config param option query model state store cache queue stack proxy route local global static
    final sample dummy change user name page file path line text data code test type time date link list item node root home main base core your here http
    html json yaml www com org net key the and ing tion ment able ness for with from this that not
    """.split()
)
SECRET_WORDS = "token|secret|password|passwd|pwd|apikey|api_key|key|auth|bearer|credential|credentials|access|private|signature|sig"
OTHER_WORDS = "commit|sha|sha1|sha256|md5|hash|checksum|digest|revision|rev|etag|uuid|guid|id|integrity|blob|tree|card|phone|iban|order|isbn|number"
PATHS = "test|example|sample|fixture|mock|doc|spec|vendor|lock"
PREFIXES = "AKIA|ASIA|ghp_|gho_|ghs_|ghr_|glpat-|xoxb-|xoxp-|xoxa-|AIza|sk_live_|sk-|rk_live_|npm_|pypi-|SG[.]|eyJ"
#: What follows a secret word (groups: word, separator, candidate; the candidate may begin the next match) and what begins with a known prefix.
AFTER = r"""(?i)(?<![a-z0-9])(%s)(["']?[ \t]{0,3}[=:][ \t]{0,3}["']?|[ \t\n"'(]{1,3})(?=([^\s"'<>=:(][^\s"'<>]*(?<![.,;:!?)\]}])))""" % SECRET_WORDS
BARE = r"(?<![A-Za-z0-9])((?:%s)[A-Za-z0-9+/_.=-]*[A-Za-z0-9+/_=-])" % PREFIXES
#: Shorter secrets are replaced only where they stand by themselves.
SHORT = 16
#: Characters that transitions tell apart: letters, any digit, and any mark (the last one, and what is none of them).
SIGNS, _DIGITS, _MARKS = "abcdefghijklmnopqrstuvwxyz0-", "123456789", "+/_"
_FOLD = str.maketrans(_DIGITS + _MARKS, "0" * len(_DIGITS) + "-" * len(_MARKS))
FEATURES = ("transitions", "n", "digits", "upper", "lower", "marks", "hops", "case_hops", "distinct", "covered", "hexadecimal", "assigned", "secret_word", "other_word", "path", "prefix")


class Forest(list):
    """Trees, and the transition table of the findings that they were grown from."""

    def __init__(self, trees: list[object], transitions: list[int]):
        super().__init__(trees)
        self.transitions = transitions


def signs(candidate: str) -> list[int]:
    found = (SIGNS.find(c) for c in candidate.lower().translate(_FOLD))
    return [k if k >= 0 else len(SIGNS) - 1 for k in found]


def transition_table(findings: list[tuple[str, str, str, str, bool]]) -> list[int]:
    """For each pair of signs, row after row: ten times the logarithm of how much likelier the second follows the first in a secret than in another run."""
    n = len(SIGNS)
    counts = np.ones((2, n, n))  # one of each pair beforehand
    for f in findings:
        codes = signs(f[0])
        np.add.at(counts[int(f[4])], (codes[:-1], codes[1:]), 1)
    shares = counts / counts.sum(2, keepdims=True)
    return np.rint(10 * np.log(shares[1] / shares[0])).astype(int).ravel().tolist()


def transitions(candidate: str, table: list[int]) -> int:
    """The mean weight of a candidate's transitions, times ten."""
    codes = signs(candidate)
    return math.floor(10 * sum(table[len(SIGNS) * a + b] for a, b in zip(codes, codes[1:], strict=False)) / max(len(candidate) - 1, 1))


def transitions_sql(c: str, table: list[int], duck: bool) -> str:
    n, to = len(SIGNS), "0" * len(_DIGITS) + "-" * len(_MARKS)
    folded = f"translate(lower({c}), '{_DIGITS}{_MARKS}', '{to}')"
    code = f"CASE WHEN instr('{SIGNS}', s) > 0 THEN instr('{SIGNS}', s) ELSE {n} END"
    if duck:
        codes = f"list_transform(string_split({folded}, ''), lambda s: {code})"
        total = f"coalesce(list_sum(list_transform(list_zip({codes}, ({codes})[2:], true), lambda p: ({table})[{n} * (p[1] - 1) + p[2]])), 0)"
    else:
        codes = f"transform(split({folded}, ''), s -> {code})"
        # the last sign has no next one; its weight is the 0 behind the table
        weight = f"element_at(array({', '.join(map(str, [*table, 0]))}), coalesce({n} * (a - 1) + b, {n * n + 1}))"
        total = f"aggregate(zip_with({codes}, slice({codes}, 2, length({c})), (a, b) -> {weight}), 0, (t, w) -> t + w)"
    return f"cast(floor(cast(10 * {total} as double) / greatest(length({c}) - 1, 1)) as int)"


def features_sql(c: str, word: str, gap: str, path: str, table: list[int], duck: bool = False) -> dict[str, str]:
    """Whole numbers about a candidate, its word before, the separator and the path."""
    g = ", 'g'" if duck else ""
    left = lambda drop, of=c: f"length(regexp_replace({of}, '{drop}', ''{g}))"
    like = lambda of, p: f"regexp_matches({of}, '{p}')" if duck else f"{of} RLIKE '{p}'"
    flag = lambda of, p: f"CASE WHEN {like(of, p)} THEN 1 ELSE 0 END"
    distinct = f"len(list_distinct(string_split({c}, '')))" if duck else f"size(array_distinct(split({c}, '')))"
    # Java's split of '' into characters has no empty tail in Spark 4; both count characters
    return {
        "transitions": transitions_sql(c, table, duck),
        "n": f"length({c})",
        "digits": left("[^0-9]"),
        "upper": left("[^A-Z]"),
        "lower": left("[^a-z]"),
        "marks": left("[A-Za-z0-9]"),
        "hops": f"(length({c}) - {left('[A-Za-z][0-9]|[0-9][A-Za-z]')})",
        "case_hops": f"(length({c}) - {left('[a-z][A-Z]|[A-Z][a-z]')})",
        "distinct": distinct,
        "covered": f"cast(floor(100 * (length({c}) - {left(DICTIONARY, f'lower({c})')}) / length({c})) as int)",
        "hexadecimal": flag(c, "^[0-9a-f]+$"),
        "assigned": flag(gap, "[=:]"),
        "secret_word": flag(f"lower({word})", f"^(.*_)?({SECRET_WORDS})$"),
        "other_word": flag(f"lower({word})", f"^(.*_)?({OTHER_WORDS})$"),
        "path": flag(f"lower({path})", PATHS),
        "prefix": flag(c, f"^({PREFIXES})"),
    }


def features(candidate: str, word: str, gap: str, path: str, table: list[int]) -> list[int]:
    """The same numbers in Python, for training."""
    kept = lambda p, s=candidate: len(re.sub(p, "", s))
    n = len(candidate)
    return [
        transitions(candidate, table), n, kept("[^0-9]"), kept("[^A-Z]"), kept("[^a-z]"), kept("[A-Za-z0-9]"), n - kept("[A-Za-z][0-9]|[0-9][A-Za-z]"), n - kept("[a-z][A-Z]|[A-Z][a-z]"), len(set(candidate)),
        100 * (n - kept(DICTIONARY, candidate.lower())) // n, int(bool(re.fullmatch("[0-9a-f]+", candidate))), int(bool(re.search("[=:]", gap))),
        int(bool(re.match(f"^(.*_)?({SECRET_WORDS})$", word.lower()))), int(bool(re.match(f"^(.*_)?({OTHER_WORDS})$", word.lower()))), int(bool(re.search(PATHS, path.lower()))), int(bool(re.match(f"^({PREFIXES})", candidate))),
    ]


def labelled_findings(n: int = 3000, seed: int = 11) -> list[tuple[str, str, str, str, bool]]:
    """Labelled findings by rule: keys of common shapes under telling words, and the long runs that are none."""
    rng = random.Random(seed)
    draw = lambda of, k: "".join(rng.choice(of) for _ in range(k))
    alnum, hexa = string.ascii_letters + string.digits, "0123456789abcdef"
    common = DICTIONARY.split("|")
    words, others, plain = SECRET_WORDS.split("|"), OTHER_WORDS.split("|"), ["the", "of", "see", "from", "line", "le", "der", "and", "", "in", "path", "url"]
    gaps = [" = ", "=", ": ", ' = "', "='", ":"]
    out = []
    for _ in range(n):
        path = rng.choice(["src/app.py", "config/settings.yml", "src0", "web/main.js", ".env", ""])
        test = rng.choice(["tests/data.py", "docs/example.md", "src/app.py", "src0", "vendor/lock.json"])
        kind = rng.random()
        if kind < 0.14:
            out.append((rng.choice(["AKIA", "ASIA"]) + draw(string.ascii_uppercase + string.digits, 16), rng.choice([*words, *plain]), rng.choice([*gaps, " "]), path, True))
        elif kind < 0.28:
            out.append((rng.choice(["ghp_", "gho_", "glpat-", "xoxb-", "sk_live_", "AIza", "npm_"]) + draw(alnum, rng.choice([24, 35, 36])), rng.choice([*words, *plain]), rng.choice([*gaps, " "]), path, True))
        elif kind < 0.40:
            out.append((draw(hexa, rng.choice([32, 40, 64])), rng.choice(words), rng.choice(gaps), path, True))
        elif kind < 0.50:
            out.append((draw(alnum + "+/_-", rng.randint(20, 64)), rng.choice(words), rng.choice(gaps), path, True))
        elif kind < 0.62:
            out.append((draw(hexa, rng.choice([32, 40, 64])), rng.choice([*others, *plain]), rng.choice([" ", ": ", "=", ""]), test, False))
        elif kind < 0.72:
            out.append((draw(string.digits, rng.randint(16, 24)), rng.choice([*others, *plain, *words[-2:]]), rng.choice([" ", ": ", "="]), test, False))
        elif kind < 0.80:
            u = draw(hexa, 32)
            out.append(("-".join((u[:8], u[8:12], u[12:16], u[16:20], u[20:])), rng.choice([*others, *plain]), rng.choice([" ", ": ", "="]), test, False))
        elif kind < 0.90:
            out.append((rng.choice("-_/").join(rng.choice(common) for _ in range(rng.randint(3, 7))) + draw(string.digits, rng.randint(1, 3)), rng.choice([*plain, *words]), rng.choice([" ", "/", *gaps]), test, False))
        elif kind < 0.96:
            out.append((rng.choice(["your_", "example_", "test_key_", "dummy-", "changeme_"]) + draw("x0", rng.randint(8, 20)) + "0123456789"[: rng.randint(1, 9)], rng.choice(words), rng.choice(gaps), test, False))
        else:
            out.append((draw(string.ascii_lowercase, rng.randint(14, 26)) + draw(string.digits, rng.randint(1, 2)), rng.choice(plain), " ", test, False))
    return [x for x in out if len(x[0]) >= 16]


def more_findings(n: int = 4000, seed: int = 12) -> list[tuple[str, str, str, str, bool]]:
    """Labelled findings of any length: passwords, dotted keys and tokens, and the words, names, numbers and placeholders that are none."""
    rng = random.Random(seed)
    draw = lambda of, k: "".join(rng.choice(of) for _ in range(k))
    low, alnum, hexa = string.ascii_lowercase, string.ascii_letters + string.digits, "0123456789abcdef"
    common, words, gaps = DICTIONARY.split("|"), SECRET_WORDS.split("|"), [" = ", "=", ": ", ' = "', "='", ":"]
    prefixes = [p.replace("[.]", ".") for p in PREFIXES.split("|")]
    a_word = lambda: draw(low, rng.randint(1, 12))
    secret = [
        lambda: draw(low, rng.randint(4, 10)) + draw(string.digits, rng.randint(1, 4)), lambda: draw(alnum, rng.randint(6, 30)) + draw(string.digits, 1), lambda: draw(alnum + "!@#$%^&*.-_", rng.randint(6, 20)) + draw("!@#$%^&*", 1) + draw(string.digits, 1),
        lambda: draw(string.ascii_letters, rng.randint(10, 40)), lambda: draw(low, rng.randint(16, 32)), lambda: draw(string.digits, rng.randint(6, 12)), lambda: draw(hexa, rng.randint(8, 15)),
    ]
    token = [lambda: f"eyJ{draw(alnum, rng.randint(12, 40))}.eyJ{draw(alnum, rng.randint(12, 80))}.{draw(alnum + '_-', rng.choice([22, 43, 86]))}", lambda: f"SG.{draw(alnum + '_-', 22)}.{draw(alnum + '_-', 43)}", lambda: rng.choice([p for p in prefixes if p not in ("AKIA", "ASIA", "eyJ")]) + draw(alnum, rng.randint(10, 50))]
    none = [
        a_word, a_word, a_word, lambda: rng.choice(common), lambda: a_word().capitalize(), lambda: draw(string.ascii_uppercase, rng.randint(2, 8)) + "_" + rng.choice(words).upper(), lambda: draw(string.digits, rng.randint(1, 4)),
        lambda: ".".join(a_word() for _ in range(rng.randint(2, 4))), lambda: rng.choice("_-").join(a_word() for _ in range(rng.randint(2, 4))), lambda: f"{a_word()}.{a_word()}({rng.choice(['', a_word()])}", lambda: rng.choice("x*.") * rng.randint(3, 20),
        lambda: rng.choice(["your_", "my-", "example_", "change_", "test_"]) + rng.choice(words), lambda: rng.choice(["$", "${", "{{", "%", "process.env."]) + draw(string.ascii_uppercase, rng.randint(3, 8)) + rng.choice(["}", "}}", "_TOKEN", ""]), lambda: rng.choice(common).upper(),
    ]
    out = []
    for _ in range(n):
        path, kind = rng.choice(["src/app.py", "config/settings.yml", "src0", "docs/example.md", ".env", ""]), rng.random()
        if kind < 0.4:
            out.append((rng.choice(secret)(), rng.choice(words), rng.choice(gaps), path, True))
        elif kind < 0.5:
            out.append((rng.choice(token)(), rng.choice([*words, "", ""]), rng.choice([*gaps, " "]), path, True))
        elif kind < 0.92:
            out.append((rng.choice(none)(), rng.choice(words), rng.choice([*gaps, " ", " ", " ", "\n"]), path, False))
        else:
            out.append((rng.choice(prefixes) + rng.choice([a_word(), a_word().upper(), f"{a_word()}_{a_word()}"]), "", "", path, False))
    return [(c, w, g if w else "", p, x) for c, w, g, p, x in out]


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int, tried: int) -> object:
    """A tree as nested (feature, threshold, low, high), a leaf as its share of secrets."""
    share = round(float(y.mean()), 4)
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return share
    best = (0.0, -1, 0.0)
    whole = share * (1 - share) * len(y)
    for j in rng.choice(x.shape[1], tried, replace=False).tolist():
        order = np.argsort(x[:, j], kind="stable")
        v, hits = x[order, j], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] != v[:-1])
        cut = cut[(cut + 1 >= least) & (len(y) - cut - 1 >= least)]
        if not len(cut):
            continue
        low, a = cut + 1.0, hits[cut]
        high, b = len(y) - low, hits[-1] - a
        gain = whole - (a * (low - a) / low + b * (high - b) / high)
        k = int(gain.argmax())
        if gain[k] > best[0] + 1e-9:
            best = (float(gain[k]), j, float(v[cut[k]] + v[cut[k] + 1]) / 2)
    if best[1] < 0:
        return share
    low = x[:, best[1]] <= best[2]
    return (best[1], best[2], _grow(x[low], y[low], rng, depth - 1, least, tried), _grow(x[~low], y[~low], rng, depth - 1, least, tried))


def train_forest(findings: list[tuple[str, str, str, str, bool]] | None = None, trees: int = 15, depth: int = 6, seed: int = 5) -> Forest:
    """A random forest: bootstrap rows, a few features tried at each node."""
    findings = labelled_findings() if findings is None else findings
    table = transition_table(findings)
    x = np.array([features(*f[:4], table) for f in findings], float)
    y = np.array([f[4] for f in findings], float)
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        out.append(_grow(x[rows], y[rows], rng, depth, 5, 5))
    return Forest(out, table)


def train_more(findings: list[tuple[str, str, str, str, bool]] | None = None) -> Forest:
    """The forest that votes on candidates of any length."""
    return train_forest(labelled_findings() + more_findings() if findings is None else findings, trees=25, depth=9)


def vote(forest: Forest, row: list[int]) -> float:
    total = 0.0
    for tree in forest:
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        total += tree
    return total / len(forest)


def forest_sql(forest: Forest, of: str) -> str:
    """The forest's mean vote over the fields of ``of``."""

    def tree_sql(tree: object) -> str:
        if not isinstance(tree, tuple):
            return f"cast({tree} as double)"
        return f"CASE WHEN {of}.{FEATURES[tree[0]]} <= {tree[1]} THEN {tree_sql(tree[2])} ELSE {tree_sql(tree[3])} END"

    return "(" + " + ".join(tree_sql(t) for t in forest) + f") / {len(forest)}"


def findings_sql(text: str, path: str, forest: Forest, duck: bool = False, threshold: float = 0.5) -> dict[str, str]:
    """SQL of the candidates (structs), of the scored structs over a column named cand, and of the secrets over one named scored."""
    if duck:
        q = "'" + PATTERN.replace("'", "''") + "'"
        arrays = [f"regexp_extract_all({text}, {q}, {k})" for k in (1, 2, 3)]
        cand = f"list_filter(list_transform(range(1, len({arrays[2]}) + 1), lambda i: {{'word': coalesce({arrays[0]}[i], ''), 'gap': coalesce({arrays[1]}[i], ''), 'c': {arrays[2]}[i]}}), lambda x: regexp_matches(x.c, '[0-9]'))"
        f = features_sql("x.c", "x.word", "x.gap", path, forest.transitions, True)
        scored = "list_transform(cand, lambda x: {'c': x.c, " + ", ".join(f"'{k}': {v}" for k, v in f.items()) + "})"
        secrets = f"list_transform(list_filter(scored, lambda x: {forest_sql(forest, 'x')} >= {threshold}), lambda x: x.c)"
        return {"cand": cand, "scored": scored, "secrets": secrets}
    q = lambda p: "'" + p.replace("\\", "\\\\").replace("'", "\\'") + "'"
    # the plain run first: the pattern with the word before is tried only on texts that hold a run with a digit
    some = f"CASE WHEN exists(regexp_extract_all({text}, {q(RUN)}, 0), x -> x RLIKE '[0-9]') THEN {text} ELSE '' END"
    part = lambda k: f"coalesce(regexp_extract(m, {q('^' + PATTERN + '$')}, {k}), '')"
    found = f"filter(regexp_extract_all({some}, {q(PATTERN)}, 0), m -> {part(3)} RLIKE '[0-9]')"
    cand = f"transform({found}, m -> named_struct('word', {part(1)}, 'gap', {part(2)}, 'c', {part(3)}))"
    f = features_sql("x.c", "x.word", "x.gap", path, forest.transitions)
    scored = "transform(cand, x -> named_struct('c', x.c, " + ", ".join(f"'{k}', {v}" for k, v in f.items()) + "))"
    secrets = f"transform(filter(scored, x -> {forest_sql(forest, 'x')} >= {threshold}), x -> x.c)"
    return {"cand": cand, "scored": scored, "secrets": secrets}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", keep: list[str] | None = None, findings: list[tuple[str, str, str, str, bool]] | None = None, threshold: float = 0.5) -> DataFrame:
    """Id, ``keep`` columns, n_candidates, secrets (long runs, then those of any length, then key blocks, each in the order of the text) of every whole text."""
    keep = [c for c in keep or [] if c != id_col]
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.select(id_col, *keep, F.col(text_col).alias("_quire_text"), path.alias("_quire_path"))
    sql = findings_sql("coalesce(_quire_text, '')", "_quire_path", train_forest(findings), threshold=threshold)
    for name in ("cand", "scored", "secrets"):
        rows = rows.withColumn(f"_quire_{name}", F.expr(sql[name].replace("transform(cand,", "transform(_quire_cand,").replace("filter(scored,", "filter(_quire_scored,")))
    block = F.contains("_quire_text", F.lit("-----BEGIN"))
    blocks = F.regexp_extract_all(F.when(block, F.col("_quire_text")).otherwise(F.lit("")), F.lit(KEY), F.lit(0))
    rows = rows.withColumn("_quire_rest", F.coalesce(F.when(block, F.regexp_replace("_quire_text", F.lit(KEY), F.lit("\n"))).otherwise(F.col("_quire_text")), F.lit("")))
    some = lambda p: F.when(F.rlike("_quire_rest", F.lit(p)), F.col("_quire_rest")).otherwise(F.lit(""))
    for k, name in enumerate(("word", "gap", "c"), 1):
        rows = rows.withColumn(f"_quire_{name}", F.regexp_extract_all(some(AFTER), F.lit(AFTER), F.lit(k)))
    rows = rows.withColumn("_quire_bare", F.regexp_extract_all(some(BARE), F.lit(BARE), F.lit(1)))
    known = "array_contains(transform(_quire_cand, y -> y.c), {})"
    after = f"transform(filter(arrays_zip(_quire_word, _quire_gap, _quire_c), x -> NOT {known.format('x._quire_c')}), x -> named_struct('word', x._quire_word, 'gap', x._quire_gap, 'c', x._quire_c))"
    bare = f"transform(filter(_quire_bare, c -> NOT {known.format('c')} AND NOT array_contains(_quire_c, c)), c -> named_struct('word', '', 'gap', '', 'c', c))"
    more = train_more(findings)
    f = features_sql("x.c", "x.word", "x.gap", "_quire_path", more.transitions)
    rows = rows.withColumn("_quire_more", F.expr(f"concat({after}, {bare})"))
    rows = rows.withColumn("_quire_also", F.expr("transform(_quire_more, x -> named_struct('c', x.c, " + ", ".join(f"'{k}', {v}" for k, v in f.items()) + "))"))
    rows = rows.withColumn("_quire_also", F.expr(f"transform(filter(_quire_also, x -> {forest_sql(more, 'x')} >= {threshold}), x -> x.c)"))
    return rows.select(id_col, *keep, (F.size("_quire_cand") + F.size("_quire_more")).cast("long").alias("n_candidates"), F.concat("_quire_secrets", "_quire_also", blocks).alias("secrets"))


def redact(docs: DataFrame, text_col: str = "text", path_col: str | None = "source", mark: str = "<secret>", length_col: str | None = "n_chars", id_col: str = "doc_id") -> DataFrame:
    """The documents, all columns kept whatever their names, with every secret in the text replaced by ``mark`` (longer ones first, short ones as whole words) and the length renewed."""
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    name = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    text = name[text_col]
    found = scan(plain, name[id_col], text, name.get(path_col), keep=plain.columns)
    longest = F.expr("array_sort(array_distinct(secrets), (a, b) -> CASE WHEN length(a) > length(b) THEN -1 WHEN length(a) < length(b) THEN 1 WHEN a < b THEN -1 WHEN a > b THEN 1 ELSE 0 END)")
    alone = lambda s: F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), F.replace(s, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E(?![A-Za-z0-9])"))
    plainly = F.lit(re.sub(r"([\\$])", r"\\\1", mark))
    clean = F.when(F.size("secrets") > 0, F.aggregate(longest, F.col(text), lambda t, s: F.when(F.length(s) < SHORT, F.regexp_replace(t, alone(s), plainly)).otherwise(F.replace(t, s, F.lit(mark))))).otherwise(F.col(text))
    out = found.withColumn("_clean", clean)
    fresh = {text: F.col("_clean")}
    if length_col in name:
        length = name[length_col]
        fresh[length] = F.when(F.size("secrets") > 0, F.length("_clean").cast(docs.schema[length_col].dataType)).otherwise(F.col(length))
    return out.select(*[fresh.get(c, F.col(c)).alias(c) for c in plain.columns]).toDF(*docs.columns)
