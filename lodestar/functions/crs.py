"""Coordinate systems from their text (WKT 1): a small tree parser that feeds the projection.

Only what the projection can honour is accepted: a projected system with the
transverse Mercator method, an angular and a linear unit (by their factors) and
any prime meridian. Anything else is refused, with the reason.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from lodestar.functions.raster import TransverseMercator

TOKEN = re.compile(r'\s*(?:(?P<text>"(?:[^"]|"")*")|(?P<number>[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)'
                   r'|(?P<word>[A-Za-z_][A-Za-z0-9_]*)|(?P<mark>[\[\](),]))')
# The names under which the supported method and its parameters go.
METHODS = ("transverse_mercator", "gauss_kruger")
PARAMETERS = ("central_meridian", "latitude_of_origin", "scale_factor", "false_easting", "false_northing")


@dataclass
class Node:
    """``WORD[values..., children...]``."""
    word: str
    values: list = field(default_factory=list)
    children: list["Node"] = field(default_factory=list)

    def all(self, word: str) -> list["Node"]:
        return [c for c in self.children if c.word == word]

    def one(self, word: str) -> "Node":
        found = self.all(word)
        if len(found) != 1:
            raise ValueError(f"{self.word} needs one {word}, not {len(found)}")
        return found[0]

    def number(self, place: int) -> float:
        if place >= len(self.values) or isinstance(self.values[place], str):
            raise ValueError(f"{self.word} has no number at place {place + 1}")
        return self.values[place]


def parse_wkt(text: str) -> Node:
    """The tree of a coordinate system's text; a malformed text is refused with the place."""
    tokens, at = [], 0
    while text[at:].strip():
        m = TOKEN.match(text, at)
        if not m:
            raise ValueError(f"malformed coordinate system at {at}: {text[at:at + 20]!r}")
        tokens.append((m.lastgroup, m.group(m.lastgroup), at))
        at = m.end()
    tokens.append(("end", "", len(text)))
    place = 0

    def take(kind: str, *marks: str) -> str:
        nonlocal place
        got, value, where = tokens[place]
        if got != kind or marks and value not in marks:
            raise ValueError(f"malformed coordinate system at {where}: expected {' or '.join(marks) or kind}, not {value or 'the end'!r}")
        place += 1
        return value

    def node(depth: int) -> Node:
        if depth > 50:
            raise ValueError("coordinate system is nested too deeply")
        out = Node(take("word").upper())
        if tokens[place][1] not in ("[", "(") or tokens[place][0] != "mark":
            return out  # a bare word, such as an axis direction
        close = {"[": "]", "(": ")"}[take("mark", "[", "(")]
        while True:
            kind, value, _ = tokens[place]
            if kind == "text":
                out.values.append(take("text")[1:-1].replace('""', '"'))
            elif kind == "number":
                out.values.append(float(take("number")))
            else:
                out.children.append(node(depth + 1))
            if take("mark", ",", close) == close:
                return out

    root = node(0)
    take("end")
    return root


def projection_of(text: str) -> TransverseMercator:
    """The projection that a coordinate system's text describes; ValueError if it isn't supported."""
    root = parse_wkt(text)
    if root.word != "PROJCS":
        raise ValueError(f"not a projected coordinate system: {root.word}")
    geo = root.one("GEOGCS")
    spheroid = geo.one("DATUM").one("SPHEROID")
    method = root.one("PROJECTION").values
    if not method or str(method[0]).lower() not in METHODS:
        raise ValueError(f"unsupported projection method: {method[0] if method else 'none'}")
    given = {}
    for p in root.all("PARAMETER"):
        name = str(p.values[0]).lower() if p.values else ""
        if name not in PARAMETERS or name in given:
            raise ValueError(f"{'repeated' if name in given else 'unknown'} projection parameter: {name}")
        given[name] = p.number(1)
    if "central_meridian" not in given:
        raise ValueError("projection parameter central_meridian is missing")
    degree = math.pi / 180
    angle = geo.one("UNIT").number(1) if geo.all("UNIT") else degree
    metre = root.one("UNIT").number(1) if root.all("UNIT") else 1.0
    a, inverse = spheroid.number(1), spheroid.number(2)
    if not (a > 0 and (inverse == 0 or inverse > 1) and angle > 0 and metre > 0):
        raise ValueError("spheroid or unit out of range")
    scale = given.get("scale_factor", 1.0)
    if scale <= 0:
        raise ValueError("scale factor out of range")
    in_degrees = angle / degree if abs(angle - degree) > 1e-12 else 1.0
    # longitudes count from the system's own meridian, as its central meridian does, so that one cancels out
    return TransverseMercator(
        central_meridian=given["central_meridian"] * in_degrees, k0=scale,
        false_easting=given.get("false_easting", 0.0) * metre, false_northing=given.get("false_northing", 0.0) * metre,
        a=a, f=1 / inverse if inverse else 0.0, latitude_of_origin=given.get("latitude_of_origin", 0.0) * in_degrees,
        unit=metre, angle=in_degrees)
