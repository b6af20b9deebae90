"""Index service with pages and pushed filters; a county's run from a configuration."""

import json
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from strataspark import cli
from strataspark.sources import geotiff, service
from strataspark.store import LayerStore
from tests.test_terrain import grid_text, raster, zip_bytes


def element(name, left, bottom, right, top, system="PL-1992", date="2020-01-01", fmt="ARC/INFO ASCII GRID"):
    corners = f"<g:boundedBy><g:Envelope><g:lowerCorner>{left} {bottom}</g:lowerCorner><g:upperCorner>{right} {top}</g:upperCorner></g:Envelope></g:boundedBy>" if left is not None else ""
    return f"<w:SkorowidzNMT2020>{corners}<w:godlo>{name}</w:godlo><w:akt_data>{date}</w:akt_data><w:format>{fmt}</w:format><w:uklad_xy>{system}</w:uklad_xy><w:url_do_pobrania>http://h/{name}.zip</w:url_do_pobrania></w:SkorowidzNMT2020>"


def page_of(rows):
    return f'<w:C xmlns:w="u" xmlns:g="v">{"".join(rows)}</w:C>'.encode()


def test_requests_carry_years_box_and_pages(spark, tmp_path):
    asked = str(tmp_path / "asked")
    every = {2020: [element(f"a{k}", k, 0, k + 1, 1) for k in range(7)] + [element("none", None, 0, 0, 0)], 2021: [element("b", 0, 0, 1, 1)], 2022: []}

    def fetch(url, timeout):
        with open(asked, "a") as f:
            f.write(url + "\n")
        q = {k: v[0] for k, v in parse_qs(urlsplit(url).query).items()}
        rows = every[int(q["typeNames"][-4:])]
        if q["typeNames"].endswith("2021") and open(asked).read().count("2021") == 1:
            return 503, "", b""
        return 200, "text/xml", page_of(rows[int(q["startIndex"]) : int(q["startIndex"]) + int(q["count"])])

    index = service.read_service(spark, fetch, {y: ("http://h/wfs", f"ms:Skorowidz{y}") for y in every}, "SkorowidzNMT2020", page=3)
    assert sorted((r.rok, r.godlo, r.left, r.lp) for r in index.collect()) == [*((2020, f"a{k}", float(k), k) for k in range(7)), (2021, "b", 0.0, 0)]
    open(asked, "w").close()
    found = service.near(index.where(F.col("rok").isin(2020, 2022)), (2.5, 0.0, 4.5, 9.0)).collect()
    urls = [{k: v[0] for k, v in parse_qs(urlsplit(u).query).items()} for u in open(asked).read().split()]
    assert sorted(r.godlo for r in found) == ["a2", "a3", "a4"]
    assert {u["typeNames"] for u in urls} == {"ms:Skorowidz2020", "ms:Skorowidz2022"} and {u["bbox"] for u in urls} == {"2.5,0,4.5,9"}
    assert sorted(u["startIndex"] for u in urls if u["typeNames"].endswith("2020")) == ["0", "3", "6"]
    assert index.where("rok >= 2021 and rok < 2022").count() == 1
    gone = service.read_service(spark, lambda *_: (404, "", b""), {2020: ("http://h", "x")}, "S")
    with pytest.raises(Exception, match="status 404"):
        gone.collect()


def test_a_county_from_a_configuration(spark, tmp_path, capsys):
    square = [[500000, 400000], [500008, 400000], [500008, 400008], [500000, 400008]]
    (tmp_path / "g.json").write_text(json.dumps({"features": [{"properties": {"JPT_NAZWA_": f"powiat {n}"}, "geometry": {"type": "Polygon", "coordinates": [[[x + d, y] for x, y in square]]}} for n, d in (("ełk", 0), ("gołdap", 900))]}))
    rows = [element("a", 500000, 400000, 500004, 400004), element("b", 500004, 400004, 500008, 400008), element("far", 600000, 400000, 600004, 400004), element("odd", 500000, 400000, 500004, 400004, "?"), element("later", 500000, 400000, 500004, 400004, fmt="TBD")]
    (tmp_path / "i.xml").write_bytes(page_of(rows))
    archives = tmp_path / "out" / "rok=2020" / "archives"
    archives.mkdir(parents=True)
    for name, left, bottom, z in (("a", 500000, 400000, 1), ("b", 500004, 400004, 2)):
        (archives / f"{name}.zip").write_bytes(zip_bytes(**{f"{name}__asc": grid_text(left, bottom, z)}))
    told = {"granice": str(tmp_path / "g.json"), "powiat": "ełk", "skorowidze": {"2020": str(tmp_path / "i.xml")}, "element": "SkorowidzNMT2020", "folder": str(tmp_path / "out"), "ustawienia": {"poziomy": [2], "blok_px": 4, "pobierz": False}}
    (tmp_path / "c.json").write_text(json.dumps(told))
    assert cli.main(["run", str(tmp_path / "c.json")]) == 0
    assert "akcja nowa" in (said := capsys.readouterr().out) and "nieznany_uklad 1" in said
    store = LayerStore(spark, str(tmp_path / "out" / "store"), 4)
    assert [r["plik"] for r in store.manifest[2020]["arkusze"]] == ["a.zip", "b.zip"] and store.about["powiat"] == "powiat ełk"
    values = raster(store.read(2020), "nmt")
    assert len(values) == 32 and values[7, 0] == 1.0 and values[0, 7] == 2.0
    assert cli.main(["export", store.path, "--format", "geotiff", "--out", str(tmp_path / "tif")]) == 0 and raster(geotiff.read(spark, str(tmp_path / "tif" / "store_2020.tif"), "pixels")) == values
    assert cli.main(["clean", store.path]) == 0 and raster(LayerStore(spark, store.path, 4).read(2020), "nmt") == values
    with pytest.raises(ValueError, match="no county"):
        cli.run(spark, told | {"powiat": "nie ma"})
