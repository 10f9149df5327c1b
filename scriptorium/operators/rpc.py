"""JSON-RPC over lines: the three search tools for an agent, and the same rules as a batch plan over logged lines."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.operators.search import DEFAULT_LIMIT, Search

# Fixed values of the protocol.
VERSIONS = ("2024-11-05", "2025-03-26", "2025-06-18")
DEFAULT_VERSION = "2025-06-18"
MOST_CHARACTERS = 1_000_000
PARSE, REQUEST, METHOD, PARAMS = -32700, -32600, -32601, -32602
BLANK = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"  # what str.strip() takes off
TEXTS = {"large": "message too large", "parse": "parse error", "object": "invalid request", "params": "params must be an object", "method": "method not found: "}
SERVER = {"name": "scriptorium", "version": "0.1.0"}

_TEXT = {"type": "string"}
TOOLS = [
    {"name": "search_docs", "description": "Ranked search over documentation sections; filter by collection and version.", "inputSchema": {"type": "object", "required": ["query"], "properties": {"query": _TEXT, "collection": _TEXT, "version": _TEXT, "limit": {"type": "integer", "default": DEFAULT_LIMIT}}}},
    {"name": "get_section", "description": "The whole text of one section by its chunk_id.", "inputSchema": {"type": "object", "required": ["chunk_id"], "properties": {"chunk_id": _TEXT}}},
    {"name": "list_collections", "description": "All collections with their versions.", "inputSchema": {"type": "object", "properties": {}}},
]


def rows_of(df: DataFrame) -> list[dict]:
    """A tool's answer: bounded by its limit, a single section, or the list of versions."""
    return [r.asDict(recursive=True) for r in df.collect()]


def dispatch(search: Search, name: str, arguments: dict) -> object:
    """The result of a tool; ValueError for an unknown tool, unknown or missing arguments, or bad values."""
    tool = next((t for t in TOOLS if t["name"] == name), None)
    if tool is None:
        raise ValueError(f"unknown tool: {name}")
    known, needed = tool["inputSchema"]["properties"], tool["inputSchema"].get("required", [])
    if not isinstance(arguments, dict) or set(arguments) - set(known) or [k for k in needed if arguments.get(k) is None]:
        raise ValueError(f"bad arguments for {name}")
    for k, v in arguments.items():
        if v is not None and known[k]["type"] == "string" and not isinstance(v, str):
            raise ValueError(f"{k} must be a string")
    given = {k: v for k, v in arguments.items() if v is not None}
    if name == "search_docs":
        return rows_of(search.search_docs(**given))
    if name == "get_section":
        found = rows_of(search.get_section(**given))
        if not found:
            raise ValueError(f"no such section: {given['chunk_id']}")
        return found[0]
    return rows_of(search.list_collections())


Tool = Callable[[str, dict], object]


def answer(tool: Tool, message: dict) -> dict | None:
    """The response to one request object, or None for a notification."""
    ident, method, params = message.get("id"), message.get("method"), message.get("params", {})
    if ident is None:
        return None

    def done(result: object) -> dict:
        return {"jsonrpc": "2.0", "id": ident, "result": result}

    def failed(code: int, text: str) -> dict:
        return {"jsonrpc": "2.0", "id": ident, "error": {"code": code, "message": text}}

    match method:
        case "ping":
            return done({})
        case "tools/list":
            return done({"tools": TOOLS})
        case "initialize":
            asked = params.get("protocolVersion") if isinstance(params, dict) else None
            return done({"protocolVersion": asked if asked in VERSIONS else DEFAULT_VERSION, "capabilities": {"tools": {}}, "serverInfo": SERVER})
        case "tools/call":
            if not isinstance(params, dict):
                return failed(PARAMS, TEXTS["params"])
            content, wrong = "", False
            try:
                content = json.dumps(tool(params.get("name", ""), params.get("arguments") or {}), ensure_ascii=False, indent=1, default=str)
            except ValueError as e:
                return failed(PARAMS, str(e))
            except Exception as e:  # noqa: BLE001  a tool's failure is its result
                content, wrong = f"error: {e}", True
            return done({"content": [{"type": "text", "text": content}], "isError": wrong})
    return failed(METHOD, f"{TEXTS['method']}{method}")


def serve(tool: Tool, lines: Iterable[str]) -> Iterable[str]:
    """One response line for each request line that wants one. Blank lines are skipped; bad lines get an error with a null id."""
    for line in lines:
        line = line.strip()
        if not line:
            continue
        problem = None
        if len(line) > MOST_CHARACTERS:
            problem = (REQUEST, TEXTS["large"])
        else:
            try:
                message = json.loads(line)
            except json.JSONDecodeError:
                problem = (PARSE, TEXTS["parse"])
            else:
                if not isinstance(message, dict):
                    problem = (REQUEST, TEXTS["object"])
        response = {"jsonrpc": "2.0", "id": None, "error": {"code": problem[0], "message": problem[1]}} if problem else answer(tool, message)
        if response is not None:
            yield json.dumps(response) + "\n"


def replay(lines: DataFrame, line: str = "line") -> DataFrame:
    """Logged lines with `outcome` and `code`, by the rules of `serve` as one plan of built-in functions.

    outcome is skipped, error, silent (a notification), or the method that answers; a call's own result is not replayed.
    Lines with NaN or repeated keys count as bad JSON here, which a lenient parser would take.
    """
    text = F.regexp_replace(F.coalesce(F.col(line), F.lit("")), f"^{BLANK}+|{BLANK}+$", "")
    doc = F.try_parse_json(text)
    kind = lambda v: F.schema_of_variant(v)
    get = lambda path: F.try_variant_get(doc, path, "string")
    params = F.try_variant_get(doc, "$.params", "variant")
    has_params = params.isNotNull()
    bad_params = F.coalesce(has_params & ~F.startswith(kind(params), F.lit("OBJECT")), F.lit(False))
    method = get("$.method")
    rules: list[tuple[Column, str, int | None]] = [
        (text == "", "skipped", None),
        (F.length(text) > MOST_CHARACTERS, "error", REQUEST),
        (doc.isNull(), "error", PARSE),
        (~F.startswith(kind(doc), F.lit("OBJECT")), "error", REQUEST),
        (get("$.id").isNull(), "silent", None),
        (method.isin("initialize", "tools/list", "ping") | (method == "tools/call") & ~bad_params, "answered", None),
        ((method == "tools/call") & bad_params, "error", PARAMS),
        (F.lit(True), "error", METHOD),
    ]
    outcome, code = F.lit(None).cast("string"), F.lit(None).cast("int")
    for test, name, number in reversed(rules):
        outcome = F.when(test, name).otherwise(outcome)
        code = F.when(test, F.lit(number).cast("int")).otherwise(code)
    asked = get("$.params.protocolVersion")
    version = F.when((outcome == "answered") & (method == "initialize"), F.when(asked.isin(*VERSIONS), asked).otherwise(DEFAULT_VERSION))
    return lines.select("*", outcome.alias("outcome"), code.alias("code"), F.when(outcome == "answered", method).alias("method"), version.alias("protocol_version"))
