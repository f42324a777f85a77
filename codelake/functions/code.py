"""Facts that need the Python grammar, computed once per text in an Arrow job.

``code_facts`` sends only the text column to Python and returns one struct, so all
other columns stay in the JVM. Repeated texts in an Arrow batch are read once.
Results depend on the interpreter, so ``PYTHON_VERSION`` is stored beside hashes.
"""

from __future__ import annotations

import ast
import builtins
import hashlib
import io
import platform
import re
import tokenize
import unicodedata
from collections import ChainMap, Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from codelake.session import small_batches

PYTHON_VERSION = platform.python_version()
READ_ERRORS = (SyntaxError, ValueError, RecursionError, MemoryError, tokenize.TokenError)

FACTS = {
    "parse_ok": "boolean",
    "dump_md5": "string",
    "structure_sha256": "string",
    "n_functions": "int",
    "n_classes": "int",
    "no_docstrings": "string",
    "renamed": "string",
    "graph": "struct<types:array<string>,parents:array<int>>",
}


def name_free(tree: ast.AST) -> ast.AST:
    """Number names by first use in one shared table; only plain arguments take part."""
    table: dict[str, str] = {}
    used = {"var": 0, "func": 0, "class": 0}

    def number(name, kind):
        if name not in table:
            table[name] = f"{kind}_{used[kind]}"
            used[kind] += 1
        return table[name]

    todo = [tree]
    while todo:
        node = todo.pop()
        match node:
            case ast.Name(ctx=ast.Load() | ast.Store()):
                node.id = number(node.id, "var")
            case ast.FunctionDef():
                node.name = number(node.name, "func")
                for arg in node.args.args:
                    arg.arg = number(arg.arg, "var")
            case ast.ClassDef():
                node.name = number(node.name, "class")
        todo.extend(reversed(list(ast.iter_child_nodes(node))))
    return tree


def name_events(node: ast.AST):
    """TXT-7: what happens to names, in reading order: (event, where, field or label).

    ``open`` and ``close`` a scope; ``bind`` or ``read`` the name in a field; ``claim`` or ``keep`` a name as such.
    A bare name that is a whole assigned value, or that an attribute is taken from, has no event.
    """
    below = ast.iter_child_nodes(node)
    if isinstance(node, ast.Name):
        yield ("read" if isinstance(node.ctx, ast.Load) else "bind"), node, "id"
        return
    if isinstance(node, (ast.Import, ast.ImportFrom)):
        for given in node.names:
            shown = given.name if isinstance(node, ast.ImportFrom) else given.name.split(".")[0]
            yield "keep", given.asname or shown, None
        return
    label = {ast.FunctionDef: "func", ast.ClassDef: "Cls"}.get(type(node))
    if label:
        yield "open", node, label
    if label == "func":
        a = node.args
        yield from (("bind", arg, "arg") for arg in [*a.posonlyargs, *a.args, *a.kwonlyargs, a.vararg, a.kwarg] if arg)
    if isinstance(node, ast.Attribute):
        below = ast.iter_child_nodes(node.value)
    if isinstance(node, ast.Assign):
        yield from (e for child in ast.iter_child_nodes(node.value) for e in name_events(child))
        for target in node.targets:
            todo = [target]
            while todo:
                part = todo.pop(0)
                if isinstance(part, ast.Name):
                    yield "claim", part.id, None
                elif isinstance(part, (ast.Tuple, ast.List)):
                    todo[:0] = part.elts
            yield from name_events(target)
        return
    for child in below:
        yield from name_events(child)
    if label:
        yield "close", node, None


def scope_renamed(tree: ast.AST) -> ast.AST:
    """TXT-7: alias stored names per scope; reads follow the nearest binding scope.

    Left as found: builtins and imported names on read, names of functions and
    classes at their uses, a bare name that is a whole assigned value, a bare name
    an attribute is taken from, and everything async functions declare.
    """
    aliases, kept, made = ChainMap(), ChainMap(dict.fromkeys(vars(builtins))), Counter()
    for event, where, field in [*name_events(tree)]:
        scope = "v" if len(aliases.maps) > 1 else "g"
        if event == "open":
            made[field] += 1
            where.name = f"{field}{made[field]}"
            aliases, kept = aliases.new_child(), kept.new_child()
        elif event == "close":
            aliases, kept = aliases.parents, kept.parents
        elif event == "keep":
            kept[where] = None
        elif event == "read":
            if where.id not in kept:
                where.id = aliases.get(where.id, where.id)
        else:
            own, name = aliases.maps[0], where if event == "claim" else getattr(where, field)
            alias = own.setdefault(name, f"{scope}{len(own) + 1}")
            if event == "bind":
                setattr(where, field, alias)
    return tree


def without_docstrings(tree: ast.AST) -> ast.AST:
    """TXT-3: a definition left without statements prints as text that no longer parses."""
    owners = (ast.Module, ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)
    for node in ast.walk(tree):
        if isinstance(node, owners) and ast.get_docstring(node, clean=False) is not None:
            del node.body[0]
    return tree


def breadth_first(tree: ast.AST) -> dict:
    """GRF-1: node types and parent positions in breadth-first order."""
    nodes, parents = [tree], [-1]
    for at, node in enumerate(nodes):
        below = list(ast.iter_child_nodes(node))
        nodes.extend(below)
        parents.extend([at] * len(below))
    return {"types": [type(n).__name__ for n in nodes], "parents": parents}


def syntax_of(text: str | None) -> dict:
    """Node types and parents of one program; a single unknown node where it cannot be read."""
    return _facts_of(text, ("graph",))["graph"] if text is not None else {"types": ["<unk>"], "parents": [-1]}


DIGIT_NAME = re.compile(r"(?<![0-9]\.)\b[A-Za-z_]\w*?[0-9]\w*", re.ASCII)
#: Characters of programs whose facts a task remembers.
HELD = 4_000_000
MARK = "Kz__"
PLACE = re.compile(MARK + r"([0-9]+)__zK")


def nameless(text: str) -> tuple[str, list[str]]:
    """The text with each name that has a digit written as its number by first use, and those names.

    Programs that differ in such names alone share this form: it is parsed once, and the parser, which keeps every name that
    it has ever read, meets few. Left as found: texts with other than ASCII characters, where a name may be none, or with escapes.
    """
    if not text.isascii() or "\\" in text or MARK in text:
        return text, []
    numbers: dict[str, int] = {}
    return DIGIT_NAME.sub(lambda m: f"{MARK}{numbers.setdefault(m[0], len(numbers))}__zK", text), [*numbers]


def named(text: str, names: list[str]) -> str:
    """Names put back in whatever was made of a nameless form."""
    return PLACE.sub(lambda m: names[int(m[1])], text) if names else text


DIGESTS = {"dump_md5": hashlib.md5, "structure_sha256": hashlib.sha256}


def _facts_of(text: str, wanted: tuple[str, ...], known: dict | None = None) -> dict:
    """The wanted facts; ``known`` holds what nameless forms gave before."""
    form, names = nameless(text)
    known = {} if known is None else known
    raw = known.get(form)
    if raw is None:
        if known.get(None, 0) > HELD:
            known.clear()
        known[None] = known.get(None, 0) + len(form)
        raw = known[form] = _raw_facts_of(form, wanted)
    found = dict(raw)
    for name in found.keys() & {"no_docstrings", "renamed"}:
        found[name] = named(found[name], names)
    for name in found.keys() & DIGESTS.keys():
        found[name] = DIGESTS[name](named(found[name], names).encode()).hexdigest()
    return found


def _raw_facts_of(text: str, wanted: tuple[str, ...]) -> dict:
    """Facts of a nameless form, with the dumps that digests are made of once its names are back."""
    try:
        tree = ast.parse(text)
    except READ_ERRORS:
        return {"parse_ok": False, "n_functions": 0, "n_classes": 0, "no_docstrings": text, "renamed": text,
                "graph": {"types": ["<unk>"], "parents": [-1]}}
    unchanged = [tree]

    def own():
        """A tree the caller may change."""
        return unchanged.pop() if unchanged else ast.parse(text)

    makers = {
        "parse_ok": lambda: True,
        "dump_md5": lambda: ast.dump(tree),
        "n_functions": lambda: sum(isinstance(n, ast.FunctionDef) for n in ast.walk(tree)),
        "n_classes": lambda: sum(isinstance(n, ast.ClassDef) for n in ast.walk(tree)),
        "graph": lambda: breadth_first(tree),
        "structure_sha256": lambda: ast.dump(name_free(own())),
        "no_docstrings": lambda: ast.unparse(without_docstrings(own())),
        "renamed": lambda: ast.unparse(scope_renamed(own())),
    }
    found = {"no_docstrings": text, "renamed": text}
    for name in makers:  # facts that change the tree come last
        if name in wanted:
            try:
                found[name] = makers[name]()
            except READ_ERRORS:
                continue
    return found


def _per_batch(batches, make, columns):
    for texts in batches:
        known = {text: make(text) for text in texts.dropna().unique()}
        yield pd.DataFrame({c: [known.get(text, {}).get(c) for text in texts] for c in columns})


def node_types() -> list[str]:
    """Every node type of the grammar in name order."""
    found, todo = set(), [ast.AST]
    while todo:
        below = todo.pop().__subclasses__()
        found |= {c.__name__ for c in below if c.__module__ == "ast"}
        todo.extend(below)
    return sorted(found)


def _once(job):
    """Keep filters on a job's result above it: pushed below, they would run the job a second time."""
    return job.asNondeterministic()


def code_facts(text: Column, *wanted: str) -> Column:
    """A struct column with the wanted entries of ``FACTS``."""
    schema = ", ".join(f"{name} {FACTS[name]}" for name in wanted)

    @F.pandas_udf(schema)
    def facts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = {}
        yield from _per_batch(batches, lambda text: _facts_of(text, wanted, known), wanted)

    return _once(facts)(text)


#: Programs that a task remembers the shape of.
SHAPES_HELD = 50_000
# Plain whole numbers, and above names with a digit: which ones they are has no part in the types and places of a tree's nodes.
WHOLE_NUMBER = re.compile(r"(?<![\w.])[1-9][0-9]{0,17}(?![\w.])", re.ASCII)


def alike(text: str) -> str:
    """The text with all such names and numbers the same: texts that are equal now have one shape, or cannot be read, all of them.

    Left as found: texts with other than ASCII characters, where a name may be none, or with escapes.
    """
    if not text.isascii() or "\\" in text:
        return text
    return WHOLE_NUMBER.sub("1", DIGIT_NAME.sub("v0", text))


def code_shapes(text: Column) -> Column:
    """parse_ok, shape and graph: the syntax graph's hash, and the graph itself on the first rows of a task that have it, else null.

    Rows whose graph is null find it by the hash: a graph that many programs share leaves each task about once.
    """
    @F.pandas_udf(f"parse_ok boolean, shape string, graph {FACTS['graph']}")
    def shapes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, met = {}, set()

        def shape(text):
            if text is None:
                return None, None, None
            form = alike(text)
            if form in known:
                return *known[form], None
            if len(known) >= SHAPES_HELD:
                known.clear()
                met.clear()
            facts = _facts_of(form, ("parse_ok", "graph"))
            graph = facts["graph"]
            name = hashlib.sha256(repr((graph["types"], graph["parents"])).encode()).hexdigest()
            known[form] = facts["parse_ok"], name
            first = name not in met
            met.add(name)
            return facts["parse_ok"], name, graph if first else None

        for texts in batches:
            yield pd.DataFrame([shape(text) for text in texts], columns=["parse_ok", "shape", "graph"], dtype=object)

    return _once(shapes)(text)


def _token_stream(text):
    return [(t.type, t.string) for t in tokenize.generate_tokens(io.StringIO(text).readline)]


def _drop_comment_tokens(text):
    try:
        kept = [token for token in _token_stream(text) if token[0] != tokenize.COMMENT]
        return {"text": tokenize.untokenize(kept)}
    except (*READ_ERRORS, IndexError, AssertionError):
        return {"text": None}


def strip_comments_tok(text: Column) -> Column:
    """TXT-2: re-emit all tokens but comments; null where the text cannot be read."""

    @F.pandas_udf("text string")
    def stripped(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _per_batch(batches, _drop_comment_tokens, ["text"])

    return _once(stripped)(text)["text"]


def mark_structure(text: Column, keep_comments: bool = False, normalize_literals: bool = True) -> Column:
    """TXT-8: tokens separated by spaces with layout marks; null where the text cannot be read."""
    marks = {
        tokenize.INDENT: "<indent>",
        tokenize.DEDENT: "<dedent>",
        tokenize.NEWLINE: "<newline>",
        tokenize.NL: "<newline>",
    }
    if not keep_comments:
        marks[tokenize.COMMENT] = ""
    if normalize_literals:
        marks |= {tokenize.NUMBER: "<num>", tokenize.STRING: "<str>"}

    def marked(text):
        try:
            return {"text": " ".join(" ".join(marks.get(*token) for token in _token_stream(text)).split())}
        except READ_ERRORS:
            return {"text": None}

    @F.pandas_udf("text string")
    def job(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _per_batch(batches, marked, ["text"])

    return _once(job)(text)["text"]


def unicode_normalize(text: Column, form: str = "NFKC", strip_accents: bool = False) -> Column:
    """TXT-12: Unicode forms, which Spark has no function for; accents are nonspacing marks.

    ASCII text is its own form and does not go to Python.
    """
    small_batches()

    @F.pandas_udf("string")
    def normalized(texts: pd.Series) -> pd.Series:
        texts = texts.str.normalize(form)
        if strip_accents:
            texts = texts.map(
                lambda s: "".join(c for c in s if unicodedata.category(c) != "Mn"), na_action="ignore")
        return texts

    other = F.regexp_like(text, F.lit(r"[^\x00-\x7F]"))
    return F.when(other, normalized(F.when(other, text))).otherwise(text)
