"""A transport over the public Entrez utilities (esearch, efetch)."""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.parse
import urllib.request
from datetime import date

from quillmine.sources.literature_api import TransportError

URL = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils"  # fixed value: the public service


def _get(service: str, timeout: float = 60.0, **params) -> str:
    key = os.environ.get("NCBI_API_KEY")
    body = urllib.parse.urlencode({"db": "pubmed", **params, **({"api_key": key} if key else {})}).encode()
    try:
        with urllib.request.urlopen(f"{URL}/{service}.fcgi", body, timeout) as answer:
            return answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        raise TransportError(e.code, e.reason) from e
    except urllib.error.URLError as e:
        raise ConnectionError(str(e.reason)) from e


def _search(term: str, start: date, end: date, **more) -> dict:
    dates = {"datetype": "pdat", "mindate": start.strftime("%Y/%m/%d"), "maxdate": end.strftime("%Y/%m/%d")}
    return json.loads(_get("esearch", term=term, retmode="json", **dates, **more))["esearchresult"]


def call(kind: str, *args):
    """The transport that ``literature_api`` describes."""
    if kind == "search":
        found = _search(*args, retmax=0, usehistory="y")
        return {"count": int(found["count"]), "web_env": found.get("webenv"), "query_key": found.get("querykey")}
    if kind == "ids":
        term, start, end, at, size = args
        return _search(term, start, end, retstart=at, retmax=size)["idlist"]
    if kind == "fetch":
        term, start, end, at, size = args
        session = call("search", term, start, end)
        return _get("efetch", WebEnv=session["web_env"], query_key=session["query_key"], retstart=at, retmax=size, retmode="xml")
    if kind == "fetch_ids":
        return _get("efetch", id=",".join(args[0]), retmode="xml")
    raise ValueError(f"unknown call {kind!r}")
