"""Geometry to and from text: WKT, GeoJSON and KML, all as column expressions."""

from __future__ import annotations

from xml.sax.saxutils import quoteattr

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartoweave.functions import geom as G

# Coordinates are written with this many decimals, trailing zeros removed.
DIGITS = 7

_NUM = r"([-+0-9.eE]+)"


def number_text(value: Column, digits: int = DIGITS) -> Column:
    return F.regexp_replace(F.format_string(f"%.{digits}f", value), r"\.?0+$", "")


def _nested(items: Column, each, opening: str, closing: str, separator: str) -> Column:
    return F.concat(F.lit(opening), F.array_join(F.transform(items, each), separator), F.lit(closing))


def _coordinates(geom: Column, pair, opening: str, closing: str, separator: str) -> Column:
    """Coordinates text of every kind; ``pair`` writes one vertex."""

    def ring(r):
        return _nested(r, pair, opening, closing, separator)

    def first_ring(part):
        return ring(part[0])

    def polygon(part):
        return _nested(part, ring, opening, closing, separator)

    def only_vertex(part):
        return pair(part[0][0])

    parts, kind = geom["parts"], geom["kind"]
    return (
        F.when(kind == "POINT", only_vertex(parts[0]))
        .when(kind == "MULTIPOINT", _nested(parts, only_vertex, opening, closing, separator))
        .when(kind == "LINESTRING", first_ring(parts[0]))
        .when(kind == "MULTILINESTRING", _nested(parts, first_ring, opening, closing, separator))
        .when(kind == "POLYGON", polygon(parts[0]))
        .when(kind == "MULTIPOLYGON", _nested(parts, polygon, opening, closing, separator))
    )


def to_wkt(geom: Column | str) -> Column:
    g = G.as_col(geom)
    text = _coordinates(
        g, lambda v: F.concat_ws(" ", number_text(v["x"]), number_text(v["y"])), "(", ")", ", "
    )
    text = F.when(g["kind"] == "POINT", F.concat(F.lit("("), text, F.lit(")"))).otherwise(text)
    return F.concat(g["kind"], F.lit(" "), text)


def _wrap_rings(rings: Column) -> Column:
    return F.transform(rings, lambda r: F.array(r))


def _wrap_points(points: Column) -> Column:
    return F.transform(points, lambda v: F.array(F.array(v)))


def _by_kind(kind: Column, flat: Column, rings: Column, polygons: Column) -> Column:
    """Parts from coordinates nested one, two or three deep."""
    parts = (
        F.when(kind.isin("POINT", "LINESTRING"), F.array(F.array(flat)))
        .when(kind == "MULTIPOINT", _wrap_points(flat))
        .when(kind == "MULTILINESTRING", _wrap_rings(rings))
        .when(kind == "POLYGON", F.array(rings))
        .when(kind == "MULTIPOLYGON", polygons)
    )
    return G.once(parts, lambda p: F.when(p.isNotNull(), F.struct(kind.alias("kind"), p.alias("parts"))))


def from_wkt(text: Column | str) -> Column:
    """Point, line, polygon and their multi forms; NULL for anything else."""
    t = F.trim(G.as_col(text))
    kind = F.upper(F.regexp_extract(t, r"^([A-Za-z]+)", 1))
    body = F.regexp_replace(t, r"^[A-Za-z]+\s*", "")
    body = F.when(
        kind == "MULTIPOINT", F.concat(F.lit("("), F.regexp_replace(body, r"[()]", ""), F.lit(")"))
    ).otherwise(body)
    json = F.regexp_replace(body, _NUM + r"\s+" + _NUM, r'{"x":$1,"y":$2}')
    json = F.translate(json, "()", "[]")
    v = G.VERTEX_TYPE
    return _by_kind(
        kind,
        F.from_json(json, f"array<{v}>"),
        F.from_json(json, f"array<array<{v}>>"),
        F.from_json(json, f"array<array<array<{v}>>>"),
    )


def to_geojson(geom: Column | str) -> Column:
    g = G.as_col(geom)
    names = F.create_map(*[F.lit(s) for pair in G.GEOJSON_KINDS.items() for s in pair])
    text = _coordinates(
        g,
        lambda v: F.concat(F.lit("["), number_text(v["x"]), F.lit(","), number_text(v["y"]), F.lit("]")),
        "[", "]", ",",
    )
    return F.concat(
        F.lit('{"type":"'), names[g["kind"]], F.lit('","coordinates":'), text, F.lit("}")
    )


def from_geojson(kind: Column, coordinates: Column) -> Column:
    """Geometry from a GeoJSON ``type`` and its ``coordinates`` text. Heights are
    dropped; a kind without coordinates gives NULL."""

    def xy(pair):
        return F.struct(pair[0].alias("x"), pair[1].alias("y"))

    pairs = F.from_json(coordinates, "array<array<double>>")
    rings = F.from_json(coordinates, "array<array<array<double>>>")
    polys = F.from_json(coordinates, "array<array<array<array<double>>>>")
    single = F.array(F.from_json(coordinates, "array<double>"))
    upper = F.upper(kind)
    flat = F.transform(F.when(upper == "POINT", single).otherwise(pairs), xy)
    return _by_kind(
        upper,
        flat,
        F.transform(rings, lambda r: F.transform(r, xy)),
        F.transform(polys, lambda p: F.transform(p, lambda r: F.transform(r, xy))),
    )


def to_feature(geom: Column | str, properties: list[str]) -> Column:
    """A GeoJSON Feature as one line of text."""
    props = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    return F.concat(
        F.lit('{"type":"Feature","properties":'), props,
        F.lit(',"geometry":'), F.coalesce(to_geojson(geom), F.lit("null")), F.lit("}"),
    )


def xml_escape(value: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(char), F.lit(entity))
    return value


def _kml_geometry(g: Column) -> Column:
    def coords(ring):
        pairs = F.transform(
            ring, lambda v: F.concat_ws(",", number_text(v["x"]), number_text(v["y"]))
        )
        return F.concat(F.lit("<coordinates>"), F.array_join(pairs, " "), F.lit("</coordinates>"))

    def point(part):
        return F.concat(F.lit("<Point>"), coords(part[0]), F.lit("</Point>"))

    def line(part):
        return F.concat(F.lit("<LineString>"), coords(part[0]), F.lit("</LineString>"))

    def polygon(part):
        def boundary(ring, i):
            tag = F.when(i == 0, F.lit("outerBoundaryIs")).otherwise(F.lit("innerBoundaryIs"))
            return F.concat(
                F.lit("<"), tag, F.lit("><LinearRing>"), coords(ring), F.lit("</LinearRing></"), tag, F.lit(">")
            )

        return F.concat(
            F.lit("<Polygon>"), F.array_join(F.transform(part, boundary), ""), F.lit("</Polygon>")
        )

    parts, label = g["parts"], G.label(g)
    body = (
        F.when(label == "points", F.array_join(F.transform(parts, point), ""))
        .when(label == "lines", F.array_join(F.transform(parts, line), ""))
        .when(label == "polygons", F.array_join(F.transform(parts, polygon), ""))
    )
    multi = F.concat(F.lit("<MultiGeometry>"), body, F.lit("</MultiGeometry>"))
    return F.when(g["kind"].startswith("MULTI"), multi).otherwise(body)


def to_placemark(geom: Column | str, properties: list[str], name: str | None = "name") -> Column:
    """A KML Placemark; NULL attributes are left out."""
    pieces = [F.lit("<Placemark>")]
    if name is not None and name in properties:
        tag = F.concat(F.lit("<name>"), xml_escape(F.col(name).cast("string")), F.lit("</name>"))
        pieces.append(F.coalesce(tag, F.lit("")))
    pieces.append(F.lit("<ExtendedData>"))
    for column in properties:
        opening = f'<Data name={quoteattr(column)}><value>'
        data = F.concat(F.lit(opening), xml_escape(F.col(column).cast("string")), F.lit("</value></Data>"))
        pieces.append(F.coalesce(data, F.lit("")))
    pieces.append(F.lit("</ExtendedData>"))
    pieces.append(F.coalesce(_kml_geometry(G.as_col(geom)), F.lit("")))
    pieces.append(F.lit("</Placemark>"))
    return F.concat(*pieces)
