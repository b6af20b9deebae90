"""Command line (K13, §2.14): run a county from a configuration; info, export, time axis and clean of a store."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strataspark.functions.grid import SIDES
from strataspark.operators import catalog
from strataspark.sources import index
from strataspark.store import LayerStore
from strataspark.yearrun import Settings, run_years


def info(store: LayerStore) -> str:
    about, lines = store.about, []
    lines.append(f"{store.path}: {about['powiat'] or '-'}, {store.grid.width}x{store.grid.height} px of {store.grid.cellsize:g} m, levels {', '.join(x.name for x in store.levels())}")
    for year, r in store.manifest.items():
        lines.append(f"{year}: {r['status']}, index {r['indeks']}, {len(r['arkusze'])} sheets, resolutions {r.get('udzial_rozdzielczosci', {})}")
    shares = store.coverage().orderBy("rok").collect()
    return "\n".join(lines + [f"{r.rok}: {r.coverage:.1%} covered" for r in shares])


#: What a configuration of a run must have: boundaries (GeoJSON) and the county's name there, paths of index XML by year, the elements' name, the output folder.
REQUIRED = ("granice", "powiat", "skorowidze", "element", "folder")


def run(spark: SparkSession, config: dict, fetch=None) -> dict[int, dict]:
    """One county from a configuration: its boundary, the sheets of the index that touch it, all years, see ``yearrun``.

    ``granice``: a GeoJSON file; ``powiat``: a pattern of the county's name; ``skorowidze``: year to a path of index XML;
    ``element``: the index elements' name; ``lata``: years, all by default; ``ustawienia``: see ``Settings``. Archives are
    loaded by ``fetch``; without it those in the folder are used.
    """
    counties = index.named(index.read_boundaries(spark, config["granice"]), config["powiat"])
    found = counties.limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{config['powiat']}: {'no county' if not found else 'more than one county'} of that name")
    rings = [[tuple(p[:2]) for p in ring] for ring in found[0].rings]
    years = index.year_list(config["lata"], 0, 0) if config.get("lata") else sorted(map(int, config["skorowidze"]))
    sheets = None
    for year in years:
        rows = index.read_index(spark, config["skorowidze"][str(year)], config["element"], year).select("*", "bounds.*").drop("bounds")
        sheets = rows if sheets is None else sheets.union(rows)
    near = catalog.touching(sheets.where(~catalog.to_be_done(F.col("format"))), rings)
    known, unknown = catalog.known_crs(near.withColumns({"plik": catalog.file_name(F.col("url_do_pobrania")), "url": F.col("url_do_pobrania")}))
    done = run_years(spark, known.select("rok", "plik", "url", "epsg", "akt_data", *SIDES), rings, Settings.of(config.get("ustawienia", {})), config["folder"], fetch, found[0].name)
    skipped = {r.rok: r.n for r in unknown.groupBy("rok").agg(F.count("*").alias("n")).collect()}  # one row per year
    return {y: what | ({"nieznany_uklad": skipped[y]} if y in skipped else {}) for y, what in done.items()}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="strataspark")
    parser.add_argument("command", choices=["info", "export", "time", "clean", "run"])
    parser.add_argument("store", help="a store's folder; for run: a configuration file")
    parser.add_argument("--format", default="parquet", choices=["parquet", "geotiff"])
    parser.add_argument("--out")
    parser.add_argument("--year", type=int)
    parser.add_argument("--factor", type=int, default=1)
    parser.add_argument("--value", default="nmt", choices=["nmt", "res_src"])
    parser.add_argument("--position", default="middle", choices=["middle", "start"])
    parser.add_argument("--unit", default="seconds", choices=["seconds", "days"])
    parser.add_argument("--bounds", default="yes", choices=["yes", "no"])
    parser.add_argument("--chunks", default="each", choices=["each", "one"])
    args = parser.parse_args(argv)
    if args.command == "run":
        done = run(SparkSession.builder.getOrCreate(), index.read_config(args.store, REQUIRED))
        print("\n".join(f"{year}: {', '.join(f'{k} {v}' for k, v in what.items())}" for year, what in done.items()))
        return int(any(what.get("akcja") == "blad" for what in done.values()))
    store = LayerStore(SparkSession.builder.getOrCreate(), args.store)
    if args.command == "info":
        print(info(store))
    elif args.command == "clean":
        print("\n".join(store.clean()))
    elif args.command == "export" and args.format == "geotiff":
        print("\n".join(store.export_geotiff(args.out or f"{args.store}/export", args.factor, args.year, args.value)))
    elif args.command == "export":
        store.export(args.out or f"{args.store}/export", args.factor, args.year, args.value)
    else:
        axis = store.rewrite_time(args.position, args.bounds == "yes", args.unit, args.chunks).orderBy("level", "indeks")
        print("\n".join(", ".join(f"{k} {v}" for k, v in row.asDict().items()) for row in axis.collect()))  # one row per year and level
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
