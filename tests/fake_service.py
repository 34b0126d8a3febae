"""Stands in for a paged service: pages come from files in a folder."""

import json
import os


def fetch(url, parameters, headers, timeout):
    path = os.path.join(url, f"offset={parameters['$offset']}.json")
    if not os.path.exists(path):
        return "[]"
    with open(path, encoding="utf-8") as handle:
        return handle.read()


def echo(url, parameters, headers, timeout):
    """One record that shows what was asked for."""
    if parameters["$offset"]:
        return "[]"
    return json.dumps([{"asked": {"q": parameters.get("q")}, "token": headers.get("X-App-Token"),
                        "limit": parameters["$limit"], "timeout": timeout, "list": [1, "é"],
                        "none": None}])


def broken(url, parameters, headers, timeout):
    return '{"error": "no list"}'
