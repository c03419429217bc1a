"""The entity loads of both domains, as shipped, over raw tables derived from the given ones: first loads, second
loads of merged stagings and of every fact through stored tables, the second day of every dimension."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.operators.catalog import column_catalog, stored_tables
from bodega.operators.control import ControlTables
from bodega.operators.joins import resolve
from bodega.plans import bank_gold, bank_silver, wholesale_gold, wholesale_silver
from bodega.plans.entity import Sources, load_changes, run_clean_layer, spaced
from bodega.plans.star import FactLoad, Star, load_dimension, load_fact, run_star_layer
from bodega.queries.base import REGISTRY, RUN_TS, Tables, plain, query
from bodega.queries.raw import RAW, raw, raw_sql
from bodega.session import cut_lineage, shared_folder
from bodega.sources.buckets import colocated
from bodega.sources.store import Store

WIDE = bank_silver.SPAN
DAY_ONE, DAY_ONE_TEXT = datetime(2024, 1, 1), "2024-01-01 00:00:00"
NOW = datetime.fromisoformat(RUN_TS)


class Flow:
    """A domain's layers over one set of tables. A dimension is settled once, as a load does it: others look it up."""

    def __init__(self, t: Tables, silver_loads, dimensions):
        self.raw, self.loads, self.dimensions = cache(raw(t)), silver_loads, dimensions
        self._silver: dict[str, DataFrame] = {}
        self._dims: dict[str, DataFrame] = {}

    def silver(self, target: str) -> DataFrame:
        if target not in self._silver:
            load = self.loads[target]
            self._silver[target] = load.rows(Sources(self.raw, NOW, ranges=load.ranges))
        return self._silver[target]

    def dims(self, target: str) -> DataFrame:
        if target not in self._dims:
            d = self.dimensions[target]
            self._dims[target] = cut_lineage(d.first(self.silver(d.staging), self.dims, NOW, cut_lineage))
        return self._dims[target]

    def fact(self, load) -> DataFrame:
        return load.build(Star(self.silver, self.dims, NOW, rows_by=load.identity))


def bank(t: Tables) -> Flow:
    return Flow(t, bank_silver.LOADS, bank_gold.DIMENSIONS)


def wholesale(t: Tables) -> Flow:
    return Flow(t, wholesale_silver.LOADS, wholesale_gold.DIMENSIONS)


# --- oracle text building -----------------------------------------------------------------------------

def _each(names: str, form: str) -> str:
    out = []
    for entry in names.split(","):
        source, _, target = (x.strip() for x in entry.partition(">"))
        out.append(f'{form.format(c=source)} as "{target or spaced(source)}"')
    return ", ".join(out)


def txt(names: str) -> str:
    return _each(names, "upper(trim({c}))")


def low(names: str) -> str:
    return _each(names, "lower(trim({c}))")


def trm(names: str) -> str:
    return _each(names, "trim({c})")


def keep(names: str) -> str:
    return _each(names, "{c}")


def num(names: str) -> str:
    return _each(names, "cast({c} as double)")


def dat(names: str) -> str:
    return _each(names, "strftime({c}, '%Y-%m-%d')")


def bit(names: str) -> str:
    return _each(names, "cast({c} as integer)")


def nul(names: str, kind: str = "varchar") -> str:
    return ", ".join(f'cast(null as {kind}) as "{n.strip()}"' for n in names.split(","))


VALID = """'2024-06-30 00:00:00' as "Valid From", '9999-12-31 23:59:59' as "Valid To", 1 as "Lineage Key\""""
FULL = "{p}Nombre || ' ' || {p}Apellido1 || coalesce(' ' || {p}Apellido2, '')"
SHORT = "{p}Nombre || ' ' || {p}Apellido1"

SILVER: dict[str, str] = {}
DIMS: dict[str, str] = {}


# Whole-number columns that hold NULLs.
FLOATS = {
    "bs_customer": ("Edad",),
    "bs_risk_profile": ("Numero Transacciones Mes", "Numero Transferencias Internacionales"),
    "gd_centre": ("Centro Padre Key",),
    "gd_customer": ("Edad",),
    "gd_risk_profile": ("Numero Transacciones Mes",),
    "ws_movement": ("WWI Customer ID", "WWI Supplier ID", "WWI Purchase Order ID"),
    "ws_order": ("WWI Backorder ID", "WWI Picker ID"),
    "ws_transaction": ("WWI Customer ID", "WWI Bill To Customer ID", "WWI Supplier ID", "WWI Customer Transaction ID",
                       "WWI Supplier Transaction ID", "WWI Invoice ID", "WWI Purchase Order ID"),
    "wf_movement": ("WWI Purchase Order ID",),
    "wf_order": ("WWI Backorder ID",),
    "wf_transaction": ("WWI Customer Transaction ID", "WWI Supplier Transaction ID", "WWI Invoice ID", "WWI Purchase Order ID"),
}


def silver(name: str, target: str, flow, tables: str, body: str):
    """Register a clean-layer load with its oracle."""
    SILVER[target] = f"with {raw_sql(*[x.strip() for x in tables.split(',')])}\n{body}"
    query(name, SILVER[target], FLOATS.get(name, ()))(lambda t: plain(flow(t).silver(target)))


def dim(name: str, target: str, flow, staging: str, key: str, business: str, drop: str = "", extra: str = "", joined: str = "",
        show_key: bool = True):
    """Register a dimension with its oracle: numbered by bucket and business id."""
    gone = ", ".join(f'"{d.strip()}"' for d in drop.split(",") if d.strip())
    number = f'row_number() over (order by s."{business}" % 1021, s."{business}") as "{key}", ' if show_key else ""
    columns = f"s.* exclude ({gone})" if gone else "s.*"
    DIMS[target] = f"select {number}{columns}{extra} from ({SILVER[staging]}) s {joined}"
    query(name, DIMS[target], FLOATS.get(name, ()))(lambda t: plain(flow(t).dims(target) if show_key else flow(t).dims(target).drop(key)))
    if show_key:  # numbered by an integer business id
        day_two(name, target, flow, key, business, f"select {columns}{extra} from ({SILVER[staging]}) s {joined}")


def fact(name: str, load, flow, body: str, name_for: tuple[str, str, str] | None = None, again: Again | None = None):
    """Register a fact with its oracle. `name_for` shows a code in place of a hash-numbered key."""
    def named(f: Flow, rows: DataFrame) -> DataFrame:
        if name_for is not None:
            column, dimension, code = name_for
            rows = resolve(rows, f.dims(dimension), {column: column}, {code: code}, unknown=None).drop(column)
        return rows

    def run(t: Tables) -> DataFrame:
        f = flow(t)
        return plain(named(f, f.fact(load)))

    query(name, body, FLOATS.get(name, ()))(run)
    if again is not None:
        fact_second_load(name, load, flow, again, body, named)


def stores(t: Tables) -> tuple[Store, Store]:
    """Empty clean and star stores in the shared folder."""
    root = f"{shared_folder(t.spark)}/loads-{uuid4().hex}"
    return Store(t.spark, f"{root}/silver"), Store(t.spark, f"{root}/gold")


def load_layer(loads, targets: list[str], read, store: Store, sort_by: dict[str, tuple[str, ...]] | None = None) -> None:
    result = run_clean_layer({n: loads[n] for n in targets}, read, store, NOW, sort_by=sort_by)
    if result.errors:
        raise RuntimeError(str(result.messages))


def by_load(store: Store, target: str, first: set[str]) -> DataFrame:
    """A stored table with the number of the load that wrote a row; `first` are the parts of the first."""
    parts = store.version(target).parts
    one, two = ([p for p in parts if (p.path in first) == early] for early in (True, False))
    return store.read(target, one).withColumn("lote", F.lit(1)).unionByName(store.read(target, two).withColumn("lote", F.lit(2)))


def paths(store: Store, target: str) -> set[str]:
    return {p.path for p in store.version(target).parts}


def second_load(name: str, target: str, flow, parts: dict[str, tuple[str, str]]):
    """Register two loads of a stored staging that merges sub-types: the lower half of each sub-type's ids, then the whole source.

    `parts` maps a sub-type to its raw table and id. The second load reads what is above the marks recorded by the first;
    together they must be the whole, each row once.
    """
    load = (bank_silver.LOADS if flow is bank else wholesale_silver.LOADS)[target]

    def run(t: Tables) -> DataFrame:
        reader, half = raw(t), {table: (ident, _half(raw(t)(table), ident)) for table, ident in parts.values()}

        def lower(table: str) -> DataFrame:
            rows = reader(table)
            return rows.filter(F.col(half[table][0]) <= half[table][1]) if table in half else rows

        store, _ = stores(t)
        load_layer({target: load}, [target], lower, store)
        first = paths(store, target)
        load_layer({target: load}, [target], reader, store)
        return plain(by_load(store, target, first))

    query(f"{name}_second_load", f"select *, {_subtype_batch(load, parts)} as lote from ({SILVER[target]})", FLOATS.get(name, ()))(run)


def _subtype_batch(load, parts: dict[str, tuple[str, str]], of: str = "") -> str:
    ident = f'{of}"{load.ident}"'
    cases = " ".join(
        f"""when {ident} between {load.ranges[part].offset + 1} and {load.ranges[part].offset} + (select max({own}) // 2 from ({RAW[table].replace('{', '').replace('}', '')})) then 1"""
        for part, (table, own) in parts.items())
    return f"case {cases} else 2 end"


def _half(rows: DataFrame, ident: str) -> int:
    return rows.agg(F.floor(F.max(ident) / 2)).first()[0] or 0


@dataclass(frozen=True)
class Again:
    """How the source of a fact's staging is cut for two loads.

    `parts`: raw tables with the id at whose half they are cut, by sub-type (one sub-type is called main). `late` is a raw date column
    that is ten years later in the second half, for stagings loaded by date, with the staging's name for it. `until` cuts by that
    date instead. `also` are other stagings that the fact reads. `ties` tell rows apart that the fact's own order does not.
    """

    staging: str
    parts: dict[str, tuple[str, str]]
    late: tuple[str, str] | None = None
    until: str | None = None
    also: tuple[str, ...] = ()
    ties: tuple[str, ...] = ()


def fact_second_load(name: str, load: FactLoad, flow, again: Again, body: str, named: Callable[[Flow, DataFrame], DataFrame]):
    """Register two loads of a stored fact: from the first half of its source, then from all of it, through stored stagings.

    The result has the surrogate keys. Stagings are stored in the order of the columns that identify a fact row, so keys given by
    place follow that order and SQL can number the rows too.
    """
    staging = (bank_silver.LOADS if flow is bank else wholesale_silver.LOADS)[again.staging]

    def loaded(t: Tables, twice: Callable[[Store, Store, Flow], None]) -> tuple[Flow, Store, set[str]]:
        f, (silver, gold) = flow(t), stores(t)
        reader = cache(raw(t))
        half = {table: (own, None if again.until else _half(reader(table), own)) for table, own in again.parts.values()}

        def source(lower: bool) -> Callable[[str], DataFrame]:
            def read(table: str) -> DataFrame:
                rows = reader(table)
                if table not in half:
                    return rows
                own, middle = half[table]
                if again.until:
                    return rows.filter(F.col(again.late[0]) <= F.lit(again.until).cast("timestamp_ntz")) if lower else rows
                if again.late:
                    day = F.col(again.late[0])
                    rows = rows.withColumn(again.late[0], F.when(F.col(own) > middle, day + F.expr("interval 10 years")).otherwise(day))
                return rows.filter(F.col(own) <= middle) if lower else rows
            return read

        first: set[str] = set()
        for lower in (True, False):
            load_layer(f.loads, [again.staging, *again.also], source(lower), silver, {again.staging: (*load.identity, *again.ties)})
            twice(silver, gold, f)
            first = first or paths(gold, load.target)
        return f, gold, first

    def once(silver: Store, gold: Store, f: Flow) -> None:
        load_fact(load, silver, gold, NOW, dims=f.dims)

    def run(t: Tables) -> DataFrame:
        f, gold, first = loaded(t, once)
        rows = by_load(gold, load.target, first) if load.by != "all" else gold.read(load.target)
        return plain(named(f, rows))

    order = ", ".join(f's."{c}" nulls first' for c in (*load.identity, *again.ties))
    source, numbered = SILVER[again.staging], f"row_number() over (order by {order})"
    if load.by == "all":
        batch, keyed, columns, condition = "1", numbered, "", ""
    elif again.until:
        batch = f"""case when s."{again.late[1]}" <= '{again.until}' then 1 else 2 end"""
        columns, condition = ", batch as lote", "where batch = 1" if load.by == "once" else ""
    else:
        if staging.ranges:
            batch = _subtype_batch(staging, again.parts, "s.")
        else:
            (table, own), = again.parts.values()
            batch = f"""case when s."{load.ident}" <= (select max({own}) // 2 from ({RAW[table].replace('{', '').replace('}', '')})) then 1 else 2 end"""
        columns, condition = ", batch as lote", ""
    if again.late and not again.until:
        (table, own), = again.parts.values()
        day = f'"{again.late[1]}"'
        source = f"""select * replace (case when "{load.ident}" > (select max({own}) // 2 from ({RAW[table].replace('{', '').replace('}', '')}))
            then strftime(cast({day} as date) + interval 10 year, '%Y-%m-%d') else {day} end as {day}) from ({source})"""
    if load.by != "all":
        numbered = f"row_number() over (partition by {batch} order by {order})"
        keyed = "case when batch = 1 then place else place + (count(*) filter (where batch = 1) over ()) end"
    text = body.replace(f"({SILVER[again.staging]}) s", f"({source}) s", 1)
    head = text.index("select ") + len("select ")
    text = f'{text[:head]}{numbered} as place, {batch} as batch, {text[head:]}'
    keyed = keyed if load.by != "all" else "place"
    sql = f"""select * exclude (place, batch), {keyed} as "{load.key}", 1 as "Lineage Key"{columns} from ({text})"""
    query(f"{name}_second_load", f"select * from ({sql}) {'where lote = 1' if condition else ''}", FLOATS.get(name, ()))(run)
    if load.by == "once":
        def race(t: Tables) -> DataFrame:
            def both(silver: Store, gold: Store, f: Flow) -> None:
                for d in load.needs:
                    f.dims(d)
                with ThreadPoolExecutor(2) as pool:
                    written = list(pool.map(lambda _: load_fact(load, silver, gold, NOW, dims=f.dims), range(2)))
                if written.count(0) < 1:
                    raise AssertionError(f"both loads have filled the fact: {written}")

            f, gold, _ = loaded(t, both)
            return plain(named(f, gold.read(load.target)).drop(load.key))

        query(f"{name}_two_writers", f"""select * exclude ("{load.key}", lote) from ({sql}) where lote = 1""", FLOATS.get(name, ()))(race)


def day_two(name: str, target: str, flow, key: str, business: str, columns: str):
    """Register the second day of a dimension that its first day (without every fifth member) has loaded.

    On the second day the late members are there, and every seventh member's first tracked column differs: texts become
    another text, and every seventh from the next one NULL; numbers grow by one; flags turn.
    """
    d = (bank_gold.DIMENSIONS if flow is bank else wholesale_gold.DIMENSIONS)[target]
    watched = next(iter(d.tracked), None)

    def run(t: Tables) -> DataFrame:
        f = flow(t)
        ident, staging = F.col(f"`{business}`"), f.silver(d.staging)
        first = cut_lineage(d.first(staging.filter(ident % 5 != 0), f.dims, DAY_ONE, cut_lineage))
        if watched is None:
            added = d.additions(first, staging, f.dims, NOW, cut_lineage)
            return plain(first.unionByName(added))
        old, kind = F.col(f"`{watched}`"), staging.schema[watched].dataType
        if isinstance(kind, T.StringType):
            new = F.when(ident % 7 == 0, "OTRO").when(ident % 7 == 1, F.lit(None)).otherwise(old)
        elif isinstance(kind, T.BooleanType):
            new = F.when(ident % 7 == 0, ~old).otherwise(old)
        else:
            new = F.when(ident % 7 == 0, old + 1).otherwise(old).cast(kind)
        return plain(d.merged(first, staging.withColumn(watched, new), f.dims, NOW, cut_lineage))

    number = f"""row_number() over (order by "{business}" % 1021, "{business}")"""
    stamped = """'{0}' as "Valid From\""""
    if watched is None:
        change, replaced = "false", "*"
    else:
        ident, old = f'"{business}"', f'"{watched}"'
        text = f"case when {ident} % 7 = 0 then 'OTRO' when {ident} % 7 = 1 then null else {old} end"
        plus = f"case when {ident} % 7 = 0 then {old} + 1 else {old} end"
        flip = f"case when {ident} % 7 = 0 then 1 - {old} else {old} end"
        new = {"text": text, "number": plus, "flag": flip}[WATCHED_KIND[target]]
        replaced = f"* replace ({new} as {old})"
        default = d.tracked[watched]
        value = "n.{0}, o.{0}".format(old).split(", ")
        if default is None:
            change = f"coalesce({value[0]} <> {value[1]}, false)"
        else:
            shown = f"'{default}'" if isinstance(default, str) else str(default)
            change = f"coalesce({value[0]}, {shown}) <> coalesce({value[1]}, {shown})"
    sql = f"""with s as ({columns}), early as (select {number} as k, * replace ('{DAY_ONE_TEXT}' as "Valid From") from s where "{business}" % 5 <> 0),
        today as (select {replaced} from s),
        pending as (select n.*, o.k is not null as was from today n left join early o on o."{business}" = n."{business}" where o.k is null or {change})
        select e.k as "{key}", e.* exclude (k) replace (case when p.was then '{RUN_TS}' else e."Valid To" end as "Valid To")
            from early e left join (select * from pending where was) p on p."{business}" = e."{business}"
        union all by name
        select (select max(k) from early) + {number} as "{key}", p.* exclude (was) from pending p"""
    query(f"{name}_day_two", sql, FLOATS.get(name, ()))(run)


# What the first tracked column of a dimension holds.
WATCHED_KIND = {
    "Dimension.Centro": "text", "Dimension.Producto": "number", "Dimension.Cliente": "text", "Dimension.PerfilRiesgo": "number",
    "Dimension.Empleado": "text", "Dimension.Cuenta": "text", "Dimension.Customer": "text", "Dimension.Stock Item": "number",
    "Dimension.Supplier": "text",
}


# --- bank, clean layer --------------------------------------------------------------------------------

silver("bs_centre", "Centro_Staging", bank, "Organizacion.Sucursales, Organizacion.ZonasGeograficas", f"""
    select {keep('SucursalID > WWI Centro ID')}, {txt('CodigoSucursal > Codigo Centro, NombreSucursal > Nombre Centro, DireccionCompleta, CodigoPostal, Localidad, Provincia')},
    'SUCURSAL' as "Tipo Centro", {txt('NombreZona > Zona Geografica')}, {trm('Telefono')}, {low('Email')}, cast(DirectorSucursal as varchar) as "Director Centro",
    {keep('NumeroEmpleados')}, {dat('FechaApertura, FechaCierre')}, {txt('EstadoSucursal > Estado Centro')}, {nul('Centro Padre')}, {VALID}
    from "Organizacion.Sucursales" left join "Organizacion.ZonasGeograficas" using (ZonaGeograficaID)""")

silver("bs_institution", "EntidadFinanciera_Staging", bank, "Riesgo.EntidadesFinancieras", f"""
    select {keep('EntidadFinancieraID > WWI Entidad ID')}, {txt('CodigoEntidad, NombreEntidad, NIF, TipoEntidad, Pais')}, {bit('EsVigente')}, {VALID}
    from "Riesgo.EntidadesFinancieras" """)

silver("bs_risk_class", "ClasificacionRiesgo_Staging", bank, "Riesgo.ClasificacionesRiesgo", f"""
    select {keep('ClasificacionRiesgoID > WWI Clasificacion ID')}, {txt('CodigoClasificacion, NombreClasificacion, Descripcion')}, {keep('NivelRiesgo')},
    {num('PorcentajeProvision')}, {bit('EsVigente')}, {VALID} from "Riesgo.ClasificacionesRiesgo" """)

silver("bs_product", "Producto_Staging", bank, "Producto.CatalogoProductos, Producto.TiposProducto, Producto.CategoriasProducto", f"""
    select {keep('ProductoID > WWI Producto ID, PlazoMinimoDias, PlazoMaximoDias, EdadMinima, EdadMaxima')},
    {txt('CodigoProducto, NombreProducto, Descripcion, NombreTipoProducto > Tipo Producto, NombreCategoria > Categoria Producto')},
    {num('TAE, TIN, Comision, ImporteMinimo, ImporteMaximo')}, {bit('RequiereGarantia, EsComercializable')}, {dat('FechaLanzamiento, FechaRetiro')}, {VALID}
    from "Producto.CatalogoProductos" join "Producto.TiposProducto" using (TipoProductoID) join "Producto.CategoriasProducto" using (CategoriaProductoID)""")

_SEGMENTS = """left join "Cliente.SegmentacionComercial" sc on sc.{key} = x.{key} left join "Cliente.Segmentos" sg on sg.SegmentoID = x.SegmentoID"""
_SEGMENT_COLUMNS = txt("NombreSegmento > Segmento, SubSegmento > Subsegmento, ClasificacionComercial, PotencialNegocio")
_CLIENT_TAIL = f"""{nul('Direccion Completa, Codigo Postal, Localidad, Provincia')}, 'ESPAÑA' as "Pais", {_SEGMENT_COLUMNS},
    {bit('EsClienteActivo')}, {dat('FechaAlta, FechaBaja')}, {VALID}"""
silver("bs_customer", "Cliente_Staging", bank, "Cliente.Personas, Cliente.PersonasJuridicas, Cliente.SegmentacionComercial, Cliente.Segmentos", f"""
    select x.PersonaID as "WWI Cliente ID", 'Persona Física' as "Tipo Cliente", {txt('NumeroDocumento')}, upper(trim({FULL.format(p='')})) as "Nombre Completo",
    {dat('FechaNacimiento > Fecha Nacimiento Constitucion')}, 2024 - year(FechaNacimiento) as "Edad", {txt('Sexo, Nacionalidad')}, {nul('Forma Juridica, CNAE')},
    {low('Email')}, {trm('TelefonoMovil, TelefonoFijo')}, {_CLIENT_TAIL} from "Cliente.Personas" x {_SEGMENTS.format(key='PersonaID')}
    union all by name select x.PersonaJuridicaID + {WIDE} as "WWI Cliente ID", 'Persona Jurídica' as "Tipo Cliente", {txt('CIF > Numero Documento, RazonSocial > Nombre Completo')},
    {dat('FechaConstitucion > Fecha Nacimiento Constitucion')}, {nul('Edad', 'bigint')}, {nul('Sexo, Telefono Fijo')}, 'ESPAÑA' as "Nacionalidad", {txt('FormaJuridica, CNAE')},
    {low('Email')}, {trm('TelefonoContacto > Telefono Movil')}, {_CLIENT_TAIL} from "Cliente.PersonasJuridicas" x {_SEGMENTS.format(key='PersonaJuridicaID')}""")

silver("bs_risk_profile", "PerfilRiesgo_Staging", bank, "Cliente.ScoreCrediticio, Cliente.PerfilTransaccional", f"""
    select {keep('PersonaID > WWI Cliente ID, ScoreCredito, NumeroTransaccionesMes, NumeroTransferenciasInternacionales')}, {txt('NivelRiesgo, FuenteScore, ModeloScoring')},
    {num('ProbabilidadImpago, LimiteEndeudamiento, ImportePromedioTransaccion, VolumenMensualOperaciones')}, {dat('FechaCalculoScore')},
    coalesce(cast(TieneOperativaInusual as integer), 0) as "Tiene Operativa Inusual",
    strftime(coalesce(FechaUltimaActualizacion, FechaCalculoScore), '%Y-%m-%d') as "Fecha Actualizacion", {VALID}
    from "Cliente.ScoreCrediticio" left join "Cliente.PerfilTransaccional" using (PersonaID)""")

silver("bs_collateral", "Garantia_Staging", bank, "Credito.Garantias, Credito.TiposGarantia", f"""
    select {keep('GarantiaID > WWI Garantia ID')}, {txt('NumeroContrato, NombreTipoGarantia > Tipo Garantia, DescripcionGarantia, EntidadTasadora, DireccionGarantia, EstadoGarantia')},
    {num('ValorTasacion')}, {dat('FechaTasacion, FechaConstitucion, FechaLiberacion')}, {bit('TieneSeguro')}, {VALID}
    from "Credito.Garantias" join "Credito.TiposGarantia" using (TipoGarantiaID)""")

silver("bs_employee", "Empleado_Staging", bank, "Organizacion.Empleados, Cliente.Personas, Organizacion.Departamentos, Organizacion.Sucursales", f"""
    select e.EmpleadoID as "WWI Empleado ID", {txt('e.NumeroEmpleado > Numero Empleado, NombreDepartamento > Departamento, NombreSucursal > Centro Asignado, e.Puesto > Puesto, e.Categoria > Categoria, e.EstadoEmpleado > Estado Empleado')},
    upper(trim({FULL.format(p='p.')})) as "Nombre Completo", upper(trim({SHORT.format(p='j.')})) as "Supervisor", lower(trim(p.Email)) as "Email",
    trim(p.TelefonoMovil) as "Telefono", strftime(e.FechaAlta, '%Y-%m-%d') as "Fecha Alta", strftime(e.FechaBaja, '%Y-%m-%d') as "Fecha Baja", {VALID}
    from "Organizacion.Empleados" e join "Cliente.Personas" p using (PersonaID) left join "Organizacion.Departamentos" using (DepartamentoID)
    left join "Organizacion.Sucursales" s on s.SucursalID = e.SucursalID left join "Organizacion.Empleados" b on b.EmpleadoID = e.SupervisorID
    left join "Cliente.Personas" j on j.PersonaID = b.PersonaID""")

_ACCOUNT = txt("NumeroCuenta, NombreTipoCuenta > Tipo Cuenta, NombreProducto > Producto, EstadoCuenta")
_LOOKUPS = 'join "Cuenta.TiposCuenta" using (TipoCuentaID) join "Producto.CatalogoProductos" p using (ProductoID)'
_NO_HOLDER = '0 as "Cliente ID", null as "Nombre Cliente", null as "Limite Descubierto", null as "Sucursal Gestion"'
silver("bs_account", "Cuenta_Staging", bank, """Cuenta.CuentasCorrientes, Cuenta.CuentasAhorro, Cuenta.CuentasNomina, Cuenta.TiposCuenta, Producto.CatalogoProductos,
    Cuenta.TitularesCuenta, Cliente.Personas, Organizacion.Sucursales""", f"""
    select CuentaCorrienteID as "WWI Cuenta ID", upper(trim(x.NumeroCuenta)) as "Numero Cuenta", {txt('NombreTipoCuenta > Tipo Cuenta, NombreProducto > Producto, EstadoCuenta, NombreSucursal > Sucursal Gestion')},
    coalesce(h.PersonaID, 0) as "Cliente ID", upper(trim(coalesce({SHORT.format(p='q.')}, ''))) as "Nombre Cliente", strftime(x.FechaApertura, '%Y-%m-%d') as "Fecha Apertura",
    strftime(x.FechaCierre, '%Y-%m-%d') as "Fecha Cierre", {num('SaldoActual, SaldoDisponible, LimiteDescubierto')}, cast(coalesce(SaldoRetenido, 0) as double) as "Saldo Retenido",
    cast(null as double) as "TAE Aplicado", 0 as "Tiene Nomina Domiciliada", {VALID}
    from "Cuenta.CuentasCorrientes" x {_LOOKUPS} left join "Cuenta.TitularesCuenta" h on h.NumeroCuenta = x.NumeroCuenta and h.TipoTitularidad = 'Titular'
    left join "Cliente.Personas" q on q.PersonaID = h.PersonaID left join "Organizacion.Sucursales" o on o.SucursalID = x.SucursalGestion
    union all by name select CuentaAhorroID + {WIDE} as "WWI Cuenta ID", {_ACCOUNT}, {_NO_HOLDER}, {dat('FechaApertura, FechaCierre')}, {num('SaldoActual, SaldoActual > Saldo Disponible, TAEAplicado')},
    0.0::double as "Saldo Retenido", 0 as "Tiene Nomina Domiciliada", {VALID} from "Cuenta.CuentasAhorro" {_LOOKUPS}
    union all by name select CuentaNominaID + {2 * WIDE} as "WWI Cuenta ID", {_ACCOUNT}, {_NO_HOLDER}, {dat('FechaApertura, FechaCierre')}, {num('SaldoActual, SaldoDisponible')},
    cast(null as double) as "TAE Aplicado", 0.0::double as "Saldo Retenido", {bit('TieneNominaDomiciliada')}, {VALID} from "Cuenta.CuentasNomina" {_LOOKUPS}""")

silver("bs_movement", "Movimiento_Staging", bank, "Cuenta.MovimientosCuenta", f"""
    select {keep('MovimientoCuentaID > WWI Movimiento ID')}, {txt('NumeroCuenta, TipoMovimiento, Concepto, NumeroCuentaContrapartida, CanalOperacion')},
    {dat('FechaMovimiento, FechaValor')}, {num('ImporteMovimiento, SaldoDespuesMovimiento')}, cast(SucursalOperacion as varchar) as "Sucursal Operacion", {VALID}
    from "Cuenta.MovimientosCuenta" """)

silver("bs_balance", "SaldoDiario_Staging", bank, "Cuenta.MovimientosCuenta", f"""
    select upper(trim(NumeroCuenta)) as "Numero Cuenta", strftime(FechaMovimiento, '%Y-%m-%d') as "Fecha", cast(min(s) as double) as "Saldo Apertura", cast(max(s) as double) as "Saldo Cierre",
    cast(min(s) as double) as "Saldo Minimo", cast(max(s) as double) as "Saldo Maximo", (((2 * sum(cast(s * 100 as bigint)) + count(*)) // (2 * count(*))) / 100.0)::double as "Saldo Promedio",
    count(*) as "Numero Movimientos", cast(sum(case when i > 0 then i else 0 end) as double) as "Importe Total Entradas", cast(sum(case when i < 0 then -i else 0 end) as double) as "Importe Total Salidas", {VALID}
    from (select *, SaldoDespuesMovimiento as s, ImporteMovimiento as i from "Cuenta.MovimientosCuenta") group by NumeroCuenta, FechaMovimiento""")

_CREDIT = f"""{keep('x.PersonaID > Cliente ID, PlazoMeses')}, {txt('NumeroContrato, NombreProducto > Producto, TipoInteres, EstadoPrestamo')}, upper(trim({FULL.format(p='p.')})) as "Nombre Cliente",
    {num('ImporteConcedido, ImportePendiente, TINAplicado, TAEAplicado, ImporteCuota')}, {dat('FechaFormalizacion, FechaPrimerVencimiento, FechaUltimoVencimiento')}"""
_DEBTOR = 'join "Producto.CatalogoProductos" using (ProductoID) left join "Cliente.Personas" p on p.PersonaID = x.PersonaID'
silver("bs_credit", "Credito_Staging", bank, "Credito.Prestamos, Credito.PrestamosHipotecarios, Producto.CatalogoProductos, Cliente.Personas, Organizacion.Sucursales", f"""
    select PrestamoID as "WWI Credito ID", 'PRESTAMO PERSONAL' as "Tipo Credito", {_CREDIT}, {dat('FechaLiquidacion')}, cast(null as double) as "Valor Tasacion Garantia",
    cast(null as double) as "LTV Porcentaje", 0 as "Tiene Seguro Vida", {txt('NombreSucursal > Sucursal Gestion')}, {VALID}
    from "Credito.Prestamos" x {_DEBTOR} left join "Organizacion.Sucursales" s on s.SucursalID = x.SucursalGestion
    union all by name select PrestamoHipotecarioID + {WIDE} as "WWI Credito ID", 'HIPOTECA' as "Tipo Credito", {_CREDIT}, null as "Fecha Liquidacion",
    {num('ValorTasacionInmueble > Valor Tasacion Garantia, LTVPorcentaje')}, {bit('TieneSeguroVida')}, null as "Sucursal Gestion", {VALID} from "Credito.PrestamosHipotecarios" x {_DEBTOR}""")

silver("bs_instalment", "Cuota_Staging", bank, "Credito.CuotasPrestamo", f"""
    select {keep('CuotaPrestamoID > WWI Cuota ID, NumeroCuota, DiasRetraso')}, {txt('NumeroContrato, EstadoCuota')}, {dat('FechaVencimiento, FechaPago')},
    {num('ImporteCuota, ImporteCapital, ImporteIntereses, ImporteComisiones, CapitalPendiente, ImportePagado')}, {VALID} from "Credito.CuotasPrestamo" """)

_TRANSFER = f"""{txt('NumeroOperacion, CuentaOrigen, Concepto, EstadoTransferencia')}, {num('ImporteTransferencia')}, {dat('FechaOperacion, FechaValor')}, 0 as "Es Pago Recurrente" """
silver("bs_transfer", "Transferencia_Staging", bank, "Transferencia.TransferenciasInternas, Transferencia.TransferenciasExternas, Transferencia.TransferenciasSEPA", f"""
    select TransferenciaInternaID as "WWI Transferencia ID", 'INTERNA' as "Tipo Transferencia", {_TRANSFER}, {txt('CuentaDestino, CanalOperacion')}, {nul('Nombre Beneficiario, Entidad Destino, Pais Destino')},
    0.0::double as "Comision Aplicada", 0 as "Es SEPA", {VALID} from "Transferencia.TransferenciasInternas"
    union all by name select TransferenciaExternaID + {WIDE} as "WWI Transferencia ID", 'EXTERNA' as "Tipo Transferencia", {_TRANSFER},
    {txt('IBANDestino > Cuenta Destino, CanalOperacion, BeneficiarioNombre > Nombre Beneficiario, EntidadDestino')}, null as "Pais Destino", {num('ComisionAplicada')}, 0 as "Es SEPA", {VALID}
    from "Transferencia.TransferenciasExternas"
    union all by name select TransferenciaSEPAID + {2 * WIDE} as "WWI Transferencia ID", 'SEPA' as "Tipo Transferencia", {_TRANSFER},
    {txt('IBANDestino > Cuenta Destino, BeneficiarioNombre > Nombre Beneficiario, PaisDestino')}, {nul('Entidad Destino, Canal Operacion')}, {num('ComisionAplicada')}, 1 as "Es SEPA", {VALID}
    from "Transferencia.TransferenciasSEPA" """)

silver("bs_provision", "Provision_Staging", bank, "Riesgo.ProvisionesContables, Riesgo.ClasificacionesRiesgo", f"""
    select {keep('ProvisionID > WWI Provision ID')}, {txt('NumeroContrato, TipoProvision, NombreClasificacion > Clasificacion Riesgo')}, {dat('FechaProvision')},
    {num('ImporteProvisionado, ImporteRecuperado, SaldoProvision, PorcentajeProvision')}, {VALID} from "Riesgo.ProvisionesContables" join "Riesgo.ClasificacionesRiesgo" using (ClasificacionRiesgoID)""")

silver("bs_risk_report", "CIRBE_Staging", bank, "Riesgo.OperacionesCIRBE, Riesgo.DeclaracionesCIRBE, Riesgo.EntidadesFinancieras, Cliente.Personas", f"""
    select {keep('OperacionCIRBEID > WWI CIRBE ID, d.PersonaID > Cliente ID')}, upper(trim({FULL.format(p='p.')})) as "Nombre Cliente",
    {txt('PeriodoDeclaracion, NombreEntidad > Entidad Financiera, TipoOperacion, NaturalezaOperacion, TipoGarantia, d.ClasificacionRiesgo > Clasificacion Riesgo')},
    {dat('FechaDeclaracion')}, {num('ImporteOperacion, SaldoVivo')}, {bit('EsOperacionDudosa')}, {VALID} from "Riesgo.OperacionesCIRBE" join "Riesgo.DeclaracionesCIRBE" d using (DeclaracionCIRBEID)
    join "Riesgo.EntidadesFinancieras" using (EntidadFinancieraID) left join "Cliente.Personas" p on p.PersonaID = d.PersonaID""")

silver("bs_guarantee", "Aval_Staging", bank, "Credito.Avales, Cliente.Personas", f"""
    select {keep('AvalID > WWI Aval ID, AvaladorPersonaID > Cliente Avalista ID')}, {txt('NumeroContrato, NumeroAval, TipoAval, EstadoAval')},
    upper(trim(coalesce(AvaladorNombre, {FULL.format(p='p.')}))) as "Nombre Avalista", {num('ImporteAvalado, PorcentajeCobertura')}, {dat('FechaConstitucion, FechaVencimiento')}, {VALID}
    from "Credito.Avales" left join "Cliente.Personas" p on p.PersonaID = AvaladorPersonaID""")

# --- bank, dimensions ---------------------------------------------------------------------------------

dim("gd_centre", "Dimension.Centro", bank, "Centro_Staging", "Centro Key", "WWI Centro ID", "Telefono, Email, Director Centro, Centro Padre", ', cast(null as bigint) as "Centro Padre Key"')
dim("gd_institution", "Dimension.EntidadFinanciera", bank, "EntidadFinanciera_Staging", "Entidad Financiera Key", "WWI Entidad ID")
dim("gd_risk_class", "Dimension.ClasificacionRiesgo", bank, "ClasificacionRiesgo_Staging", "Clasificacion Riesgo Key", "Codigo Clasificacion",
    "WWI Clasificacion ID, Valid From, Valid To", show_key=False)
dim("gd_product", "Dimension.Producto", bank, "Producto_Staging", "Producto Key", "WWI Producto ID",
    "Importe Minimo, Importe Maximo, Plazo Minimo Dias, Plazo Maximo Dias, Edad Minima, Edad Maxima")
dim("gd_customer", "Dimension.Cliente", bank, "Cliente_Staging", "Cliente Key", "WWI Cliente ID", "Telefono Fijo, Clasificacion Comercial")
dim("gd_risk_profile", "Dimension.PerfilRiesgo", bank, "PerfilRiesgo_Staging", "Perfil Riesgo Key", "WWI Cliente ID",
    "Fecha Calculo Score, Fuente Score, Importe Promedio Transaccion, Numero Transferencias Internacionales, Fecha Actualizacion")
dim("gd_collateral", "Dimension.Garantia", bank, "Garantia_Staging", "Garantia Key", "WWI Garantia ID", "Numero Contrato, Direccion Garantia, Fecha Constitucion, Fecha Liberacion")
dim("gd_employee", "Dimension.Empleado", bank, "Empleado_Staging", "Empleado Key", "WWI Empleado ID", "Telefono")
dim("gd_account", "Dimension.Cuenta", bank, "Cuenta_Staging", "Cuenta Key", "WWI Cuenta ID", "Cliente ID, Saldo Actual, Saldo Disponible, Saldo Retenido, Limite Descubierto",
    ', coalesce(c."Cliente Key", 0) as "Cliente Key"', f'left join ({DIMS["Dimension.Cliente"]}) c on c."WWI Cliente ID" = s."Cliente ID"')


@query("gd_risk_class_keys", f"""select count(*) as n, 1 as menor, count(*) as mayor, count(*) as distintas, count(*) filter ("WWI Clasificacion ID" % 5 = 0) as nuevas,
    count(*) filter ("WWI Clasificacion ID" % 5 <> 0) + 1 as primera_nueva from ({SILVER['ClasificacionRiesgo_Staging']})""")
def gd_risk_class_keys(t: Tables) -> DataFrame:
    """The second day of the dimension whose keys are numbered by a hash of a code: dense, unique, new members after the old ones."""
    d, f = bank_gold.DIMENSIONS["Dimension.ClasificacionRiesgo"], bank(t)
    _, gold = stores(t)
    staging = f.silver(d.staging)
    load_dimension(d, lambda _: staging.filter(F.col("`WWI Clasificacion ID`") % 5 != 0), gold, DAY_ONE)
    old = gold.rows(d.target)
    load_dimension(d, lambda _: staging, gold, NOW)
    key = F.col(f"`{d.key}`")
    codes = staging.filter(F.col("`WWI Clasificacion ID`") % 5 == 0).select("Codigo Clasificacion", F.lit(True).alias("_new"))
    marked = gold.read(d.target).join(codes, "Codigo Clasificacion", "left")
    return plain(marked.agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("menor"), F.max(key).alias("mayor"), F.count_distinct(key).alias("distintas"),
        F.count_if("_new").alias("nuevas"), F.coalesce(F.min(F.when(F.col("_new"), key)), F.lit(old + 1)).alias("primera_nueva")))


second_load("bs_customer", "Cliente_Staging", bank, {"person": ("Cliente.Personas", "PersonaID"), "company": ("Cliente.PersonasJuridicas", "PersonaJuridicaID")})
second_load("bs_account", "Cuenta_Staging", bank, {
    "current": ("Cuenta.CuentasCorrientes", "CuentaCorrienteID"), "savings": ("Cuenta.CuentasAhorro", "CuentaAhorroID"), "payroll": ("Cuenta.CuentasNomina", "CuentaNominaID")})
second_load("bs_credit", "Credito_Staging", bank, {"loan": ("Credito.Prestamos", "PrestamoID"), "mortgage": ("Credito.PrestamosHipotecarios", "PrestamoHipotecarioID")})
second_load("bs_transfer", "Transferencia_Staging", bank, {
    "internal": ("Transferencia.TransferenciasInternas", "TransferenciaInternaID"), "external": ("Transferencia.TransferenciasExternas", "TransferenciaExternaID"),
    "sepa": ("Transferencia.TransferenciasSEPA", "TransferenciaSEPAID")})

# --- bank, changed and vanished source rows reach a dimension -----------------------------------------

_S = f"""select s.* exclude ("Telefono Fijo", "Clasificacion Comercial") from ({SILVER['Cliente_Staging']}) s"""
_ORDER = """row_number() over (order by "WWI Cliente ID" % 1021, "WWI Cliente ID")"""


@query("snapshot_two_days", f"""with s as ({_S}), early as (select {_ORDER} as k, * replace ('{DAY_ONE_TEXT}' as "Valid From") from s
        where "WWI Cliente ID" > {WIDE} or "WWI Cliente ID" % 5 <> 0),
    today as (select * replace (case when "WWI Cliente ID" <= {WIDE} and "WWI Cliente ID" % 7 = 0 then 1 - "Es Cliente Activo" else "Es Cliente Activo" end as "Es Cliente Activo")
        from s where "WWI Cliente ID" > {WIDE} or "WWI Cliente ID" % 11 <> 0),
    pending as (select n.*, o.k is not null as was from today n left join early o on o."WWI Cliente ID" = n."WWI Cliente ID"
        where o.k is null or n."Es Cliente Activo" <> o."Es Cliente Activo"),
    closes as (select "WWI Cliente ID" as id from pending where was union select "WWI Cliente ID" from early where "WWI Cliente ID" not in (select "WWI Cliente ID" from today))
    select k as "Cliente Key", * exclude (k) replace (case when "WWI Cliente ID" in (select id from closes) then '{RUN_TS}' else "Valid To" end as "Valid To") from early
    union all by name select (select max(k) from early) + {_ORDER} as "Cliente Key", * exclude (was) from pending""", FLOATS["gd_customer"])
def snapshot_two_days(t: Tables) -> DataFrame:
    """Two days of a whole raw source: late, changed and vanished persons, staged by their digests, then merged."""
    reader, (silver, gold) = raw(t), stores(t)
    load, d = bank_silver.LOADS["Cliente_Staging"], bank_gold.DIMENSIONS["Dimension.Cliente"]
    ident, active = F.col("PersonaID"), F.col("EsClienteActivo")

    def day(first: bool) -> Callable[[str], DataFrame]:
        def read(table: str) -> DataFrame:
            rows = reader(table)
            if table != "Cliente.Personas":
                return rows
            if first:
                return rows.filter(ident % 5 != 0)
            return rows.filter(ident % 11 != 0).withColumn("EsClienteActivo", F.when(ident % 7 == 0, ~active).otherwise(active))
        return read

    for when, first in ((DAY_ONE, True), (NOW, False)):
        load_changes(load, day(first), silver, when)
        load_dimension(d, silver.read, gold, when)
    return plain(gold.read(d.target))


@query("layer_held_back", """select 'load Dimension.Payment Method' as proceso, 0 as filas, 'Error' as estado, 'source is gone' as motivo
    union all select 'load Dimension.Stock Item', (select count(*) from part), 'Exitoso', null
    union all select 'load Dimension.Transaction Type', (select count(*) from nation), 'Exitoso', null
    union all select 'load Fact.Stock Holding', (select count(*) from part), 'Exitoso', null
    union all select 'load Fact.Transaction', 0, 'Error', 'held back: Dimension.Payment Method failed'""")
def layer_held_back(t: Tables) -> DataFrame:
    """The run log of a layer in which one dimension fails: the fact that looks it up is held back, the others load."""
    silver, gold = stores(t)
    load_layer(wholesale_silver.LOADS, ["StockItem_Staging", "TransactionType_Staging", "StockHolding_Staging"], raw(t), silver)

    def read(table: str) -> DataFrame:
        if table == "PaymentMethod_Staging":
            raise RuntimeError("source is gone")
        return silver.read(table)

    some = {n: wholesale_gold.DIMENSIONS[n] for n in ("Dimension.Payment Method", "Dimension.Stock Item", "Dimension.Transaction Type")}
    run_star_layer(some, {n: wholesale_gold.FACTS[n] for n in ("Fact.Transaction", "Fact.Stock Holding")}, read, gold, NOW, parallel=3)
    log = ControlTables(gold).log()
    return plain(log.select(F.col("NombreProceso").alias("proceso"), F.col("RegistrosCargados").alias("filas"), F.col("Estado").alias("estado"),
                            F.col("MensajeError").alias("motivo")))


@query("layer_runs", f"""with n as (select (select count(*) from region) as clases, (select count(*) from nation) as entidades),
    cargas as (select 1 as corrida, 'ClasificacionRiesgo_Staging' as tabla, clases as filas from n union all select 1, 'EntidadFinanciera_Staging', entidades from n
        union all select 2, 'EntidadFinanciera_Staging', 0 union all select 3, 'ClasificacionRiesgo_Staging', 0 union all select 3, 'EntidadFinanciera_Staging', 0)
    select 'registro' as parte, tabla, corrida, filas, 'Exitoso' as estado from cargas
    union all select 'control', tabla, 3, null, 'OK' from cargas where corrida = 1
    union all select 'filas', tabla, null, filas, null from cargas where corrida = 1""", ("corrida", "filas"))
def layer_runs(t: Tables) -> DataFrame:
    """A whole layer, one table of it alone, and the whole again: its log, control rows and row counts, as the status report has them."""
    silver, _ = stores(t)
    some = {n: bank_silver.LOADS[n] for n in ("ClasificacionRiesgo_Staging", "EntidadFinanciera_Staging")}
    runs = [datetime(2024, 6, 27 + i) for i in range(1, 4)]
    for when, only in zip(runs, (None, "EntidadFinanciera_Staging", None), strict=True):
        run_clean_layer(some, raw(t), silver, when, only=only, parallel=2)
    status = ControlTables(silver).status({n: silver.read(n) for n in some})
    number = F.dayofmonth("FechaEjecucion") - 27
    return plain(
        status["runs"].select(F.lit("registro").alias("parte"), F.col("TablaDestino").alias("tabla"), number.alias("corrida"),
                              F.col("RegistrosCargados").alias("filas"), F.col("Estado").alias("estado"))
        .unionByName(status["control"].select(
            F.lit("control").alias("parte"), F.col("TablaStagingDestino").alias("tabla"), (F.dayofmonth("FechaUltimaEjecucion") - 27).alias("corrida"),
            F.lit(None).cast("bigint").alias("filas"), F.col("Estado").alias("estado")))
        .unionByName(status["rows"].select(
            F.lit("filas").alias("parte"), F.col("Tabla").alias("tabla"), F.lit(None).cast("int").alias("corrida"), F.col("Filas").alias("filas"),
            F.lit(None).cast("string").alias("estado"))))


# --- bank, facts --------------------------------------------------------------------------------------

def dkey(column: str, target: str, of: str = "s") -> str:
    return f"""coalesce(cast(replace({of}."{column}", '-', '') as bigint), 0) as "{target}\""""


def cols(names: str) -> str:
    return ", ".join(f's."{n.strip()}"' for n in names.split(","))


CLIENTS, ACCOUNTS = DIMS["Dimension.Cliente"], DIMS["Dimension.Cuenta"]
_HOLDER = f"""left join (select cr."Numero Contrato" as contrato, min(c."Cliente Key") as k from ({SILVER['Credito_Staging']}) cr join ({CLIENTS}) c on c."WWI Cliente ID" = cr."Cliente ID"
    group by 1) h on h.contrato = s."Numero Contrato" """
_BY_ACCOUNT = f'left join ({ACCOUNTS}) a on a."Numero Cuenta" = s."{{0}}"'
_ACCOUNT_KEYS = 'coalesce(a."Cuenta Key", 0) as "{0}", coalesce(a."Cliente Key", 0) as "Cliente Key"'

fact("gf_movement", bank_gold.FACTS["Fact.Movimiento"], bank, f"""select {dkey('Fecha Movimiento', 'Fecha Movimiento Key')}, {dkey('Fecha Valor', 'Fecha Valor Key')}, {_ACCOUNT_KEYS.format('Cuenta Key')},
    {cols('Tipo Movimiento, Concepto, Importe Movimiento, Saldo Despues Movimiento, Canal Operacion, WWI Movimiento ID')}, 0 as "Centro Key"
    from ({SILVER['Movimiento_Staging']}) s {_BY_ACCOUNT.format('Numero Cuenta')}""", again=Again("Movimiento_Staging", {"main": ("Cuenta.MovimientosCuenta", "MovimientoCuentaID")}))

fact("gf_account_balance", bank_gold.FACTS["Fact.SaldoCuenta"], bank, f"""select {dkey('Fecha', 'Fecha Key')}, {_ACCOUNT_KEYS.format('Cuenta Key')}, 0 as "Producto Key",
    {cols('Saldo Apertura, Saldo Cierre, Saldo Promedio, Numero Movimientos, Importe Total Entradas, Importe Total Salidas')}
    from ({SILVER['SaldoDiario_Staging']}) s {_BY_ACCOUNT.format('Numero Cuenta')}""",
     again=Again("SaldoDiario_Staging", {"main": ("Cuenta.MovimientosCuenta", "MovimientoCuentaID")}, ("FechaMovimiento", "Fecha"), "2024-01-15"))

fact("gf_credit", bank_gold.FACTS["Fact.Credito"], bank, f"""select {dkey('Fecha Formalizacion', 'Fecha Formalizacion Key')}, 20240630 as "Fecha Snapshot Key", coalesce(c."Cliente Key", 0) as "Cliente Key",
    coalesce(p.k, 0) as "Producto Key", 0 as "Garantia Key", 0 as "Centro Key", {cols('Numero Contrato, Tipo Credito, Importe Concedido, Importe Pendiente, TIN Aplicado, TAE Aplicado, Plazo Meses, Estado Prestamo, WWI Credito ID')},
    s."Importe Pendiente" as "Capital Pendiente", 0.0::double as "Intereses Devengados", 0.0::double as "Provision Dotada", coalesce(q.pend, 0) as "Cuotas Pendientes",
    coalesce(q.imp, 0) as "Cuotas Impagadas", coalesce(q.ret, 0) as "Dias Retraso Maximo"
    from ({SILVER['Credito_Staging']}) s left join ({CLIENTS}) c on c."WWI Cliente ID" = s."Cliente ID"
    left join (select "Nombre Producto" as n, min("Producto Key") as k from ({DIMS['Dimension.Producto']}) group by 1) p on p.n = s."Producto"
    left join (select "Numero Contrato" as nc, count(*) filter ("Estado Cuota" = 'PENDIENTE') as pend, count(*) filter ("Estado Cuota" = 'IMPAGADA') as imp, max("Dias Retraso") as ret
        from ({SILVER['Cuota_Staging']}) group by 1) q on q.nc = s."Numero Contrato" """,
    again=Again("Credito_Staging", {"loan": ("Credito.Prestamos", "PrestamoID"), "mortgage": ("Credito.PrestamosHipotecarios", "PrestamoHipotecarioID")}, also=("Cuota_Staging",)))

fact("gf_instalment", bank_gold.FACTS["Fact.CuotaPrestamo"], bank, f"""select {dkey('Fecha Vencimiento', 'Fecha Vencimiento Key')}, {dkey('Fecha Pago', 'Fecha Pago Key')}, coalesce(h.k, 0) as "Cliente Key",
    {cols('Numero Contrato, Numero Cuota, Importe Cuota, Importe Capital, Importe Intereses, Importe Comisiones, Capital Pendiente, Importe Pagado, Estado Cuota, Dias Retraso, WWI Cuota ID')}
    from ({SILVER['Cuota_Staging']}) s {_HOLDER}""", again=Again(
        "Cuota_Staging", {"main": ("Credito.CuotasPrestamo", "CuotaPrestamoID")}, also=("Credito_Staging",),
        ties=("Fecha Vencimiento", "Importe Cuota", "Importe Capital", "Importe Intereses", "Estado Cuota", "Dias Retraso")))

fact("gf_transfer", bank_gold.FACTS["Fact.Transferencia"], bank, f"""select {dkey('Fecha Operacion', 'Fecha Operacion Key')}, {dkey('Fecha Valor', 'Fecha Valor Key')}, {_ACCOUNT_KEYS.format('Cuenta Origen Key')},
    {cols('Tipo Transferencia, Numero Operacion, Nombre Beneficiario, Pais Destino, Importe Transferencia, Comision Aplicada, Estado Transferencia, Canal Operacion, Es Pago Recurrente, Es SEPA, WWI Transferencia ID')}
    from ({SILVER['Transferencia_Staging']}) s {_BY_ACCOUNT.format('Cuenta Origen')}""", again=Again("Transferencia_Staging", {
        "internal": ("Transferencia.TransferenciasInternas", "TransferenciaInternaID"), "external": ("Transferencia.TransferenciasExternas", "TransferenciaExternaID"),
        "sepa": ("Transferencia.TransferenciasSEPA", "TransferenciaSEPAID")}))

_CLASS = ("Clasificacion Riesgo Key", "Dimension.ClasificacionRiesgo", "Codigo Clasificacion")
_BY_CLASS = f'left join ({DIMS["Dimension.ClasificacionRiesgo"]}) k on k."Nombre Clasificacion" = s."Clasificacion Riesgo"'
fact("gf_provision", bank_gold.FACTS["Fact.Provision"], bank, f"""select {dkey('Fecha Provision', 'Fecha Provision Key')}, coalesce(h.k, 0) as "Cliente Key", k."Codigo Clasificacion",
    {cols('Numero Contrato, Tipo Provision, Importe Provisionado, Importe Recuperado, Saldo Provision, Porcentaje Provision, WWI Provision ID')}
    from ({SILVER['Provision_Staging']}) s {_HOLDER} {_BY_CLASS}""", _CLASS,
    Again("Provision_Staging", {"main": ("Riesgo.ProvisionesContables", "ProvisionID")}, also=("Credito_Staging",)))

fact("gf_risk_report", bank_gold.FACTS["Fact.CIRBE"], bank, f"""select {dkey('Fecha Declaracion', 'Fecha Declaracion Key')}, coalesce(c."Cliente Key", 0) as "Cliente Key", coalesce(e."Entidad Financiera Key", 0) as "Entidad Financiera Key",
    k."Codigo Clasificacion", {cols('Periodo Declaracion, Tipo Operacion, Naturaleza Operacion, Importe Operacion, Saldo Vivo, Tipo Garantia, Es Operacion Dudosa, WWI CIRBE ID')},
    s."Importe Operacion" as "Riesgo Directo", 0.0::double as "Riesgo Indirecto", 0.0::double as "Provision Dotada" from ({SILVER['CIRBE_Staging']}) s left join ({CLIENTS}) c on c."WWI Cliente ID" = s."Cliente ID"
    left join ({DIMS['Dimension.EntidadFinanciera']}) e on e."Nombre Entidad" = s."Entidad Financiera" {_BY_CLASS}""", _CLASS,
    Again("CIRBE_Staging", {"main": ("Riesgo.OperacionesCIRBE", "OperacionCIRBEID")}))

fact("gf_guarantee", bank_gold.FACTS["Fact.Aval"], bank, f"""select {dkey('Fecha Constitucion', 'Fecha Constitucion Key')}, {dkey('Fecha Vencimiento', 'Fecha Vencimiento Key')}, coalesce(h.k, 0) as "Cliente Titular Key",
    coalesce(c."Cliente Key", 0) as "Cliente Avalista Key", {cols('Numero Contrato, Numero Aval, Tipo Aval, Importe Avalado, Porcentaje Cobertura, Estado Aval, WWI Aval ID')}
    from ({SILVER['Aval_Staging']}) s {_HOLDER} left join ({CLIENTS}) c on c."WWI Cliente ID" = s."Cliente Avalista ID" """,
    again=Again("Aval_Staging", {"main": ("Credito.Avales", "AvalID")}, also=("Credito_Staging",)))

# --- wholesale, clean layer ---------------------------------------------------------------------------

SEEN = dat("ValidFrom, ValidTo")
silver("ws_city", "City_Staging", wholesale, "Application.Cities, Application.StateProvinces, Application.Countries", f"""
    select {keep('CityID > WWI City ID')}, {txt('CityName > City, StateProvinceName > State Province, CountryName > Country, Continent, SalesTerritory, Region, Subregion')},
    coalesce(LatestRecordedPopulation, 0) as "Latest Recorded Population", {SEEN} from "Application.Cities" join "Application.StateProvinces" using (StateProvinceID) join "Application.Countries" using (CountryID)""")

_POSTAL = """left(replace(coalesce(c.PostalPostalCode, ''), ' ', ''), 10) as "Postal Code\""""
_SEEN = dat("c.ValidFrom > Valid From, c.ValidTo > Valid To")
silver("ws_customer", "Customer_Staging", wholesale, "Sales.Customers, Sales.CustomerCategories, Sales.BuyingGroups, Application.People", f"""
    select c.CustomerID as "WWI Customer ID", {txt('c.CustomerName > Customer, b.CustomerName > Bill To Customer, CustomerCategoryName > Category, FullName > Primary Contact')},
    coalesce(upper(trim(BuyingGroupName)), 'N/A') as "Buying Group", {_POSTAL}, {_SEEN} from "Sales.Customers" c left join "Sales.Customers" b on b.CustomerID = c.BillToCustomerID
    left join "Sales.CustomerCategories" k on k.CustomerCategoryID = c.CustomerCategoryID left join "Sales.BuyingGroups" g on g.BuyingGroupID = c.BuyingGroupID left join "Application.People" p on p.PersonID = c.PrimaryContactPersonID""")

silver("ws_employee", "Employee_Staging", wholesale, "Application.People", f"""
    select {keep('PersonID > WWI Employee ID')}, {txt('FullName > Employee')}, {low('PreferredName')}, {bit('IsSalesperson')}, {SEEN} from "Application.People" where IsEmployee""")

silver("ws_payment_method", "PaymentMethod_Staging", wholesale, "Application.PaymentMethods", f"""
    select {keep('PaymentMethodID > WWI Payment Method ID')}, replace(upper(trim(PaymentMethodName)), 'CHECK', 'CHEQUE') as "Payment Method", {SEEN} from "Application.PaymentMethods" """)

silver("ws_stock_item", "StockItem_Staging", wholesale, "Warehouse.StockItems, Warehouse.Colors, Warehouse.PackageTypes", f"""
    select {keep('StockItemID > WWI Stock Item ID, LeadTimeDays, QuantityPerOuter, Barcode')}, {txt('StockItemName > Stock Item, o.PackageTypeName > Selling Package, u.PackageTypeName > Buying Package')},
    coalesce(upper(trim(ColorName)), 'N/A') as "Color", coalesce(upper(trim(Brand)), 'N/A') as "Brand", coalesce(upper(trim(Size)), 'N/A') as "Size", {bit('IsChillerStock')},
    {num('TaxRate, UnitPrice, RecommendedRetailPrice, TypicalWeightPerUnit')}, {SEEN} from "Warehouse.StockItems" left join "Warehouse.Colors" using (ColorID)
    left join "Warehouse.PackageTypes" o on o.PackageTypeID = OuterPackageID left join "Warehouse.PackageTypes" u on u.PackageTypeID = UnitPackageID""")

silver("ws_supplier", "Supplier_Staging", wholesale, "Purchasing.Suppliers, Purchasing.SupplierCategories, Application.People", f"""
    select {keep('c.SupplierID > WWI Supplier ID, SupplierReference, PaymentDays')}, {txt('SupplierName > Supplier, SupplierCategoryName > Category, FullName > Primary Contact')}, {_POSTAL}, {_SEEN}
    from "Purchasing.Suppliers" c left join "Purchasing.SupplierCategories" using (SupplierCategoryID) left join "Application.People" p on p.PersonID = c.PrimaryContactPersonID""")

silver("ws_transaction_type", "TransactionType_Staging", wholesale, "Application.TransactionTypes", f"""
    select {keep('TransactionTypeID > WWI Transaction Type ID')}, {txt('TransactionTypeName > Transaction Type')}, {SEEN} from "Application.TransactionTypes" """)

silver("ws_stock_holding", "StockHolding_Staging", wholesale, "Warehouse.StockItemHoldings", f"""
    select {keep('StockItemID > WWI Stock Item ID, QuantityOnHand, LastStocktakeQuantity, ReorderLevel, TargetStockLevel')}, {txt('BinLocation')}, {num('LastCostPrice')} from "Warehouse.StockItemHoldings" """)

silver("ws_movement", "Movement_Staging", wholesale, "Warehouse.StockItemTransactions", f"""
    select {dat('TransactionOccurredWhen > Date Key')}, {keep('StockItemID > WWI Stock Item ID, CustomerID > WWI Customer ID, SupplierID > WWI Supplier ID, TransactionTypeID > WWI Transaction Type ID, StockItemTransactionID > WWI Stock Item Transaction ID')},
    {keep('InvoiceID > WWI Invoice ID, PurchaseOrderID > WWI Purchase Order ID, Quantity')} from "Warehouse.StockItemTransactions" """)


def _half_up(expr: str) -> str:
    return f"cast(cast({expr} as decimal(18,2)) as double)"


silver("ws_order", "Order_Staging", wholesale, "Sales.Orders, Sales.OrderLines, Warehouse.PackageTypes", f"""
    select {keep('CustomerID > WWI Customer ID, StockItemID > WWI Stock Item ID, SalespersonPersonID > WWI Salesperson ID, PickedByPersonID > WWI Picker ID, OrderID > WWI Order ID, BackorderOrderID > WWI Backorder ID, Quantity')},
    {dat("OrderDate > Order Date Key")}, strftime(coalesce(PickingCompletedWhen, timestamp '1900-01-01'), '%Y-%m-%d') as "Picked Date Key", {txt('Description, PackageTypeName > Package')},
    {num('UnitPrice, TaxRate')}, {_half_up('Quantity * UnitPrice')} as "Total Excluding Tax", {_half_up('Quantity * UnitPrice * TaxRate * 0.01')} as "Tax Amount",
    {_half_up('Quantity * UnitPrice * (1 + TaxRate * 0.01)')} as "Total Including Tax" from "Sales.Orders" join "Sales.OrderLines" using (OrderID) join "Warehouse.PackageTypes" using (PackageTypeID)""")

silver("ws_purchase", "Purchase_Staging", wholesale, "Purchasing.PurchaseOrders, Purchasing.PurchaseOrderLines, Warehouse.StockItems, Warehouse.PackageTypes", f"""
    select {dat('OrderDate > Date Key')}, {keep('SupplierID > WWI Supplier ID, l.StockItemID > WWI Stock Item ID, PurchaseOrderID > WWI Purchase Order ID, OrderedOuters, ReceivedOuters')},
    OrderedOuters * QuantityPerOuter as "Ordered Quantity", {txt('PackageTypeName > Package')}, {bit('IsOrderFinalized')} from "Purchasing.PurchaseOrders" join "Purchasing.PurchaseOrderLines" l using (PurchaseOrderID)
    join "Warehouse.StockItems" i on i.StockItemID = l.StockItemID join "Warehouse.PackageTypes" k on k.PackageTypeID = l.PackageTypeID""")

silver("ws_sale", "Sale_Staging", wholesale, "Sales.Invoices, Sales.InvoiceLines, Warehouse.StockItems, Warehouse.PackageTypes", f"""
    select {keep('CustomerID > WWI Customer ID, BillToCustomerID > WWI Bill To Customer ID, l.StockItemID > WWI Stock Item ID, SalespersonPersonID > WWI Salesperson ID, InvoiceID > WWI Invoice ID, Quantity')},
    {dat('InvoiceDate > Invoice Date Key')}, strftime(coalesce(ConfirmedDeliveryTime, timestamp '1900-01-01'), '%Y-%m-%d') as "Delivery Date Key", {txt('Description, PackageTypeName > Package')},
    {num('l.UnitPrice > Unit Price, l.TaxRate > Tax Rate, LineProfit > Total Excluding Tax, TaxAmount, LineProfit > Profit, ExtendedPrice > Total Including Tax')},
    case when IsChillerStock then 0.0 else cast(ExtendedPrice as double) end as "Total Dry Items", case when IsChillerStock then cast(ExtendedPrice as double) else 0.0 end as "Total Chiller Items"
    from "Sales.Invoices" join "Sales.InvoiceLines" l using (InvoiceID) join "Warehouse.StockItems" i on i.StockItemID = l.StockItemID join "Warehouse.PackageTypes" k on k.PackageTypeID = l.PackageTypeID""")

_MONEY = f"""{dat('TransactionDate > Date Key')}, {keep('TransactionTypeID > WWI Transaction Type ID, PaymentMethodID > WWI Payment Method ID')}, {num('TransactionAmount > Total Excluding Tax, TaxAmount')},
    cast(TransactionAmount + TaxAmount as double) as "Total Including Tax", {num('OutstandingBalance')}, {bit('IsFinalized')}"""
silver("ws_transaction", "Transaction_Staging", wholesale, "Sales.CustomerTransactions, Purchasing.SupplierTransactions", f"""
    select {_MONEY}, {keep('CustomerID > WWI Customer ID, CustomerTransactionID > WWI Customer Transaction ID, InvoiceID > WWI Invoice ID')},
    {nul('WWI Bill To Customer ID, WWI Supplier ID, WWI Supplier Transaction ID, WWI Purchase Order ID', 'bigint')} from "Sales.CustomerTransactions"
    union all by name select {_MONEY}, {keep('SupplierID > WWI Supplier ID, PurchaseOrderID > WWI Purchase Order ID')}, SupplierTransactionID + 1000000 as "WWI Supplier Transaction ID" from "Purchasing.SupplierTransactions" """)

# --- headers and lines stored in buckets --------------------------------------------------------------

LINES = {
    "ws_order": ("Order_Staging", {"Sales.Orders": "OrderID", "Sales.OrderLines": "OrderID"}),
    "ws_purchase": ("Purchase_Staging", {"Purchasing.PurchaseOrders": "PurchaseOrderID", "Purchasing.PurchaseOrderLines": "PurchaseOrderID"}),
    "ws_sale": ("Sale_Staging", {"Sales.Invoices": "InvoiceID", "Sales.InvoiceLines": "InvoiceID"}),
}


def bucketed_rows(t: Tables, target: str, keys: dict[str, str]) -> DataFrame:
    """A load of lines whose header and line tables are stored in buckets of the header's id."""
    run = uuid4().hex
    read = colocated(t.spark, raw(t), keys, lambda table: f"{table.replace('.', '_')}_{run}", f"{shared_folder(t.spark)}/buckets-{run}", 8)
    return wholesale_silver.LOADS[target].rows(Sources(read, NOW))


for _name, (_target, _keys) in LINES.items():
    query(f"{_name}_bucketed", SILVER[_target], FLOATS.get(_name, ()))(lambda t, target=_target, keys=_keys: plain(bucketed_rows(t, target, keys)))

# --- wholesale, dimensions and facts ------------------------------------------------------------------

_GOLD_VALID = f", {VALID}"
for _name, _target, _staging, _key, _business in (
    ("wd_city", "Dimension.City", "City_Staging", "City Key", "WWI City ID"),
    ("wd_customer", "Dimension.Customer", "Customer_Staging", "Customer Key", "WWI Customer ID"),
    ("wd_employee", "Dimension.Employee", "Employee_Staging", "Employee Key", "WWI Employee ID"),
    ("wd_payment_method", "Dimension.Payment Method", "PaymentMethod_Staging", "Payment Method Key", "WWI Payment Method ID"),
    ("wd_stock_item", "Dimension.Stock Item", "StockItem_Staging", "Stock Item Key", "WWI Stock Item ID"),
    ("wd_supplier", "Dimension.Supplier", "Supplier_Staging", "Supplier Key", "WWI Supplier ID"),
    ("wd_transaction_type", "Dimension.Transaction Type", "TransactionType_Staging", "Transaction Type Key", "WWI Transaction Type ID"),
):
    dim(_name, _target, wholesale, _staging, _key, _business, "Valid From, Valid To", _GOLD_VALID)


def _star(role: str) -> tuple[str, str]:
    dimension, own, business, key = wholesale_gold.ROLES[role]
    alias = role.lower().replace(" ", "_")
    return (f'coalesce({alias}."{key}", 0) as "{role}"',
            f'left join (select "{business}", "{key}" from ({DIMS[dimension]})) {alias} on {alias}."{business}" = s."{own}"')


def wholesale_fact(name: str, target: str, staging: str, roles: str, columns: str, again: Again, extra: str = ""):
    pairs = [_star(r.strip()) for r in roles.split(",")]
    fact(name, wholesale_gold.FACTS[target], wholesale,
         f"select {', '.join(p[0] for p in pairs)}, {cols(columns)}{extra} from ({SILVER[staging]}) s {' '.join(p[1] for p in pairs)}", again=again)


wholesale_fact("wf_stock_holding", "Fact.Stock Holding", "StockHolding_Staging", "Stock Item Key",
               "Quantity On Hand, Bin Location, Last Stocktake Quantity, Last Cost Price, Reorder Level, Target Stock Level",
               Again("StockHolding_Staging", {"main": ("Warehouse.StockItemHoldings", "StockItemID")}))
wholesale_fact("wf_movement", "Fact.Movement", "Movement_Staging", "Stock Item Key, Customer Key, Supplier Key, Transaction Type Key",
               "Date Key, WWI Stock Item Transaction ID, WWI Invoice ID, WWI Purchase Order ID, Quantity",
               Again("Movement_Staging", {"main": ("Warehouse.StockItemTransactions", "StockItemTransactionID")}, ("TransactionOccurredWhen", "Date Key"),
                     ties=("Date Key", "WWI Stock Item ID", "WWI Customer ID", "WWI Supplier ID", "WWI Transaction Type ID", "Quantity")))
wholesale_fact("wf_order", "Fact.Order", "Order_Staging", "Customer Key, Stock Item Key, Salesperson Key, Picker Key", """Order Date Key, Picked Date Key, WWI Order ID,
    WWI Backorder ID, Description, Package, Quantity, Unit Price, Tax Rate, Total Excluding Tax, Tax Amount, Total Including Tax""",
               Again("Order_Staging", {"main": ("Sales.Orders", "OrderID")}, ("OrderDate", "Order Date Key"),
                     ties=("Package", "Tax Rate")), ', 0 as "City Key"')
wholesale_fact("wf_purchase", "Fact.Purchase", "Purchase_Staging", "Supplier Key, Stock Item Key",
               "Date Key, WWI Purchase Order ID, Ordered Outers, Ordered Quantity, Received Outers, Package, Is Order Finalized",
               Again("Purchase_Staging", {"main": ("Purchasing.PurchaseOrders", "PurchaseOrderID")}, ("OrderDate", "Date Key"), ties=("Package",)))
wholesale_fact("wf_sale", "Fact.Sale", "Sale_Staging", "Customer Key, Bill To Customer Key, Stock Item Key, Salesperson Key", """Invoice Date Key, Delivery Date Key, WWI Invoice ID,
    Description, Package, Quantity, Unit Price, Tax Rate, Total Excluding Tax, Tax Amount, Profit, Total Including Tax, Total Dry Items, Total Chiller Items""",
               Again("Sale_Staging", {"main": ("Sales.Invoices", "InvoiceID")}, ("InvoiceDate", "Invoice Date Key"),
                     ties=("Package", "Tax Rate", "Profit")), ', 0 as "City Key"')
wholesale_fact("wf_transaction", "Fact.Transaction", "Transaction_Staging", "Customer Key, Supplier Key, Transaction Type Key, Payment Method Key", """Date Key, WWI Customer Transaction ID,
    WWI Supplier Transaction ID, WWI Invoice ID, WWI Purchase Order ID, Total Excluding Tax, Tax Amount, Total Including Tax, Outstanding Balance, Is Finalized""",
    Again("Transaction_Staging", {"customer": ("Sales.CustomerTransactions", ""), "supplier": ("Purchasing.SupplierTransactions", "")}, ("TransactionDate", "Date Key"), "1995-06-17"),
    ', 0 as "Bill To Customer Key", cast(null as varchar) as "Supplier Invoice Number"')


_HOLDING = wholesale_gold.FACTS["Fact.Stock Holding"]


@query("catalog_keys", f"""select 'Dimension' as schema_name, 'Stock Item' as table_name, column_name, cast(column_name = 'Stock Item Key' as integer) as es_pk, 0 as es_fk from (describe {DIMS['Dimension.Stock Item']})
    union all select 'Fact', 'Stock Holding', column_name, 0, cast(column_name = 'Stock Item Key' as integer) from (describe {REGISTRY['wf_stock_holding'].oracle})
    union all select 'Fact', 'Stock Holding', 'Stock Holding Key', 1, 0 union all select 'Fact', 'Stock Holding', 'Lineage Key', 0, 0""")
def catalog_keys(t: Tables) -> DataFrame:
    """The dictionary of a loaded star: its own keys and those of other tables, as the loads have marked them."""
    silver, gold = stores(t)
    load_layer(wholesale_silver.LOADS, ["StockItem_Staging", "StockHolding_Staging"], raw(t), silver)
    load_dimension(wholesale_gold.DIMENSIONS["Dimension.Stock Item"], silver.read, gold, NOW)
    load_fact(_HOLDING, silver, gold, NOW)
    names = {n: tuple(n.split(".")) for n in ("Dimension.Stock Item", "Fact.Stock Holding")}
    columns = column_catalog(t.spark, stored_tables(gold, "Gold", "almacen", names))
    return plain(columns.filter("data_type <> 'binary'").select("schema_name", "table_name", "column_name", "es_pk", "es_fk"))
