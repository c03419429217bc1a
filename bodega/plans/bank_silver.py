"""Bank, raw to clean: 17 loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.functions.amounts import money
from bodega.functions.dates import age_in_years, moment
from bodega.functions.text import clean_text, full_name
from bodega.operators.facts import daily_balance
from bodega.operators.incremental import id_ranges
from bodega.operators.joins import q
from bodega.plans.entity import CleanLoad, Sources, arrange, nothing

# Ids that each sub-type has room for in a merged id space; an id beyond ends the load with an error.
SPAN = 10**12
CUSTOMERS = id_ranges(person=0, company=SPAN)
ACCOUNTS = id_ranges(current=0, savings=SPAN, payroll=2 * SPAN)
CREDITS = id_ranges(loan=0, mortgage=SPAN)
TRANSFERS = id_ranges(internal=0, external=SPAN, sepa=2 * SPAN)
# The tags of the sub-types.
PERSON, COMPANY, COUNTRY = "Persona Física", "Persona Jurídica", "ESPAÑA"
BRANCH, LOAN, MORTGAGE = "SUCURSAL", "PRESTAMO PERSONAL", "HIPOTECA"
MAIN_HOLDER = "Titular"


def _shifted(ident: str, offset: int):
    own = q(ident).cast("bigint")
    fits = own.isNull() | own.between(1 if offset else 0, SPAN)
    wrong = F.concat(F.lit(f"{ident} is outside its id range: "), own.cast("string"))
    return F.when(fits, own + F.lit(offset)).otherwise(F.raise_error(wrong).cast("bigint"))


def _people(s: Sources, prefix: str, second: bool = True) -> DataFrame:
    """Person id and full name under prefixed names, to join as many times as a load needs."""
    third = "Apellido2" if second else None
    return s("Cliente.Personas").select(q("PersonaID").alias(f"{prefix}ID"), full_name("Nombre", "Apellido1", third).alias(f"{prefix}Nombre"))


def centre(s: Sources) -> DataFrame:
    zones = s("Organizacion.ZonasGeograficas", "ZonaGeograficaID, NombreZona")
    rows = s.fresh("Organizacion.Sucursales", "SucursalID").join(zones, "ZonaGeograficaID", "left")
    return arrange(
        rows.withColumn("DirectorSucursal", q("DirectorSucursal").cast("string")),
        """SucursalID > WWI Centro ID, CodigoSucursal > Codigo Centro, NombreSucursal > Nombre Centro, = Tipo Centro,
        DireccionCompleta, CodigoPostal, Localidad, Provincia, NombreZona > Zona Geografica, Telefono, Email,
        DirectorSucursal > Director Centro, NumeroEmpleados, FechaApertura, FechaCierre,
        EstadoSucursal > Estado Centro, = Centro Padre""",
        {"Tipo Centro": F.lit(BRANCH), "Centro Padre": nothing("string")},
    )


def institution(s: Sources) -> DataFrame:
    return arrange(s.fresh("Riesgo.EntidadesFinancieras", "EntidadFinancieraID"),
                   "EntidadFinancieraID > WWI Entidad ID, CodigoEntidad, NombreEntidad, NIF, TipoEntidad, Pais, EsVigente")


def risk_class(s: Sources) -> DataFrame:
    return arrange(s.fresh("Riesgo.ClasificacionesRiesgo", "ClasificacionRiesgoID"),
                   """ClasificacionRiesgoID > WWI Clasificacion ID, CodigoClasificacion, NombreClasificacion, Descripcion,
                   NivelRiesgo, PorcentajeProvision, EsVigente""")


def product(s: Sources) -> DataFrame:
    rows = (
        s.fresh("Producto.CatalogoProductos", "ProductoID")
        .join(s("Producto.TiposProducto", "TipoProductoID, NombreTipoProducto"), "TipoProductoID")
        .join(s("Producto.CategoriasProducto", "CategoriaProductoID, NombreCategoria"), "CategoriaProductoID")
    )
    return arrange(rows, """ProductoID > WWI Producto ID, CodigoProducto, NombreProducto, Descripcion,
        NombreTipoProducto > Tipo Producto, NombreCategoria > Categoria Producto, TAE, TIN, Comision, ImporteMinimo,
        ImporteMaximo, PlazoMinimoDias, PlazoMaximoDias, RequiereGarantia, EdadMinima, EdadMaxima, EsComercializable,
        FechaLanzamiento, FechaRetiro""")


def customer(s: Sources) -> DataFrame:
    segments = s("Cliente.Segmentos", "SegmentoID, NombreSegmento")
    kept = "SubSegmento, ClasificacionComercial, PotencialNegocio"

    def with_segments(rows: DataFrame, key: str) -> DataFrame:
        side = s.attribute("Cliente.SegmentacionComercial", key, kept, "FechaSegmentacion")
        return rows.join(side, key, "left").join(segments, "SegmentoID", "left")

    tail = """= Direccion Completa, = Codigo Postal, = Localidad, = Provincia, = Pais, NombreSegmento > Segmento,
        SubSegmento > Subsegmento, ClasificacionComercial, PotencialNegocio, EsClienteActivo, FechaAlta, FechaBaja"""
    text = nothing("string")
    common = {"Direccion Completa": text, "Codigo Postal": text, "Localidad": text, "Provincia": text, "Pais": F.lit(COUNTRY)}
    people = arrange(
        with_segments(s.fresh("Cliente.Personas", "PersonaID", "person"), "PersonaID"),
        f"""= WWI Cliente ID, = Tipo Cliente, NumeroDocumento, = Nombre Completo,
        FechaNacimiento > Fecha Nacimiento Constitucion, = Edad, Sexo, Nacionalidad, = Forma Juridica, = CNAE, Email,
        TelefonoMovil, TelefonoFijo, {tail}""",
        {
            "WWI Cliente ID": _shifted("PersonaID", s.offset("person")), "Tipo Cliente": F.lit(PERSON),
            "Nombre Completo": clean_text(full_name("Nombre", "Apellido1", "Apellido2")),
            "Edad": age_in_years("FechaNacimiento", moment(s.run_ts)), "Forma Juridica": text, "CNAE": text, **common,
        },
    )
    companies = arrange(
        with_segments(s.fresh("Cliente.PersonasJuridicas", "PersonaJuridicaID", "company"), "PersonaJuridicaID"),
        f"""= WWI Cliente ID, = Tipo Cliente, CIF > Numero Documento, RazonSocial > Nombre Completo,
        FechaConstitucion > Fecha Nacimiento Constitucion, = Edad, = Sexo, = Nacionalidad, FormaJuridica, CNAE, Email,
        TelefonoContacto > Telefono Movil, = Telefono Fijo, {tail}""",
        {
            "WWI Cliente ID": _shifted("PersonaJuridicaID", s.offset("company")), "Tipo Cliente": F.lit(COMPANY),
            "Edad": nothing("int"), "Sexo": text, "Nacionalidad": F.lit(COUNTRY), "Telefono Fijo": text, **common,
        },
    )
    return people.unionByName(companies)


def risk_profile(s: Sources) -> DataFrame:
    scores = s.fresh("Cliente.ScoreCrediticio", "PersonaID").filter(q("PersonaID").isNotNull())
    habits = s.attribute(
        "Cliente.PerfilTransaccional", "PersonaID",
        """NumeroTransaccionesMes, ImportePromedioTransaccion, VolumenMensualOperaciones, NumeroTransferenciasInternacionales,
        TieneOperativaInusual, FechaUltimaActualizacion""", "FechaUltimaActualizacion")
    return arrange(scores.join(habits, "PersonaID", "left"), """PersonaID > WWI Cliente ID, ScoreCredito, NivelRiesgo,
        ProbabilidadImpago, LimiteEndeudamiento, FechaCalculoScore, FuenteScore, ModeloScoring, NumeroTransaccionesMes,
        ImportePromedioTransaccion, VolumenMensualOperaciones, NumeroTransferenciasInternacionales,
        = Tiene Operativa Inusual, = Fecha Actualizacion""", {
        "Tiene Operativa Inusual": F.coalesce(q("TieneOperativaInusual"), F.lit(False)),
        "Fecha Actualizacion": F.coalesce(q("FechaUltimaActualizacion"), q("FechaCalculoScore")),
    })


def collateral(s: Sources) -> DataFrame:
    kinds = s("Credito.TiposGarantia", "TipoGarantiaID, NombreTipoGarantia")
    return arrange(s.fresh("Credito.Garantias", "GarantiaID").join(kinds, "TipoGarantiaID"), """GarantiaID > WWI Garantia ID,
        NumeroContrato, NombreTipoGarantia > Tipo Garantia, DescripcionGarantia, ValorTasacion, FechaTasacion,
        EntidadTasadora, DireccionGarantia, TieneSeguro, FechaConstitucion, FechaLiberacion, EstadoGarantia""")


def employee(s: Sources) -> DataFrame:
    person = s("Cliente.Personas", "PersonaID, Nombre, Apellido1, Apellido2, Email, TelefonoMovil")
    boss = s("Organizacion.Empleados").select(q("EmpleadoID").alias("SupervisorID"), q("PersonaID").alias("JefeID"))
    rows = (
        s.fresh("Organizacion.Empleados", "EmpleadoID")
        .join(person, "PersonaID")
        .join(s("Organizacion.Departamentos", "DepartamentoID, NombreDepartamento"), "DepartamentoID", "left")
        .join(s("Organizacion.Sucursales", "SucursalID, NombreSucursal"), "SucursalID", "left")
        .join(boss, "SupervisorID", "left")
        .join(_people(s, "Jefe", second=False), "JefeID", "left")
    )
    return arrange(rows, """EmpleadoID > WWI Empleado ID, NumeroEmpleado, = Nombre Completo, Email, TelefonoMovil > Telefono,
        NombreDepartamento > Departamento, NombreSucursal > Centro Asignado, Puesto, Categoria, JefeNombre > Supervisor,
        FechaAlta, FechaBaja, EstadoEmpleado""", {"Nombre Completo": clean_text(full_name("Nombre", "Apellido1", "Apellido2"))})


def account(s: Sources) -> DataFrame:
    kinds = s("Cuenta.TiposCuenta", "TipoCuentaID, NombreTipoCuenta")
    products = s("Producto.CatalogoProductos", "ProductoID, NombreProducto")
    zero, amount = money(F.lit(0)), lambda c: F.coalesce(q(c), money(F.lit(0)))
    layout = """= WWI Cuenta ID, NumeroCuenta, NombreTipoCuenta > Tipo Cuenta, NombreProducto > Producto, = Cliente ID,
        = Nombre Cliente, FechaApertura, FechaCierre, = Saldo Actual, = Saldo Disponible, = Saldo Retenido,
        = Limite Descubierto, = TAE Aplicado, = Tiene Nomina Domiciliada, EstadoCuenta, = Sucursal Gestion"""
    none = {
        "Cliente ID": F.lit(0).cast("bigint"), "Nombre Cliente": nothing("string"), "Saldo Retenido": zero,
        "Limite Descubierto": nothing("decimal(18,2)"), "TAE Aplicado": nothing("decimal(5,3)"),
        "Tiene Nomina Domiciliada": F.lit(False), "Sucursal Gestion": nothing("string"),
    }

    def subtype(table: str, ident: str, part: str) -> DataFrame:
        return s.fresh(table, ident, part).join(kinds, "TipoCuentaID").join(products, "ProductoID")

    holders = s("Cuenta.TitularesCuenta").filter(q("TipoTitularidad") == MAIN_HOLDER).select("NumeroCuenta", q("PersonaID").alias("TitularID"))
    offices = s("Organizacion.Sucursales").select(q("SucursalID").alias("SucursalGestion"), "NombreSucursal")
    current = (
        subtype("Cuenta.CuentasCorrientes", "CuentaCorrienteID", "current")
        .join(holders, "NumeroCuenta", "left")
        .join(_people(s, "Titular", second=False), "TitularID", "left")
        .join(offices, "SucursalGestion", "left")
    )
    savings = subtype("Cuenta.CuentasAhorro", "CuentaAhorroID", "savings")
    payroll = subtype("Cuenta.CuentasNomina", "CuentaNominaID", "payroll")
    parts = [
        arrange(current, layout, {
            **none, "WWI Cuenta ID": _shifted("CuentaCorrienteID", s.offset("current")),
            "Cliente ID": F.coalesce(q("TitularID").cast("bigint"), F.lit(0).cast("bigint")),
            "Nombre Cliente": clean_text(F.coalesce(q("TitularNombre"), F.lit(""))),
            "Saldo Actual": amount("SaldoActual"), "Saldo Disponible": amount("SaldoDisponible"),
            "Saldo Retenido": amount("SaldoRetenido"), "Limite Descubierto": q("LimiteDescubierto"),
            "Sucursal Gestion": clean_text("NombreSucursal"),
        }),
        arrange(savings, layout, {
            **none, "WWI Cuenta ID": _shifted("CuentaAhorroID", s.offset("savings")),
            "Saldo Actual": amount("SaldoActual"), "Saldo Disponible": amount("SaldoActual"), "TAE Aplicado": q("TAEAplicado"),
        }),
        arrange(payroll, layout, {
            **none, "WWI Cuenta ID": _shifted("CuentaNominaID", s.offset("payroll")),
            "Saldo Actual": amount("SaldoActual"), "Saldo Disponible": amount("SaldoDisponible"),
            "Tiene Nomina Domiciliada": F.coalesce(q("TieneNominaDomiciliada"), F.lit(False)),
        }),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def movement(s: Sources) -> DataFrame:
    return arrange(s.fresh("Cuenta.MovimientosCuenta", "MovimientoCuentaID"), """MovimientoCuentaID > WWI Movimiento ID,
        NumeroCuenta, FechaMovimiento, FechaValor, TipoMovimiento, Concepto, ImporteMovimiento, SaldoDespuesMovimiento,
        NumeroCuentaContrapartida, CanalOperacion, = Sucursal Operacion""",
        {"Sucursal Operacion": q("SucursalOperacion").cast("string")})


def balance(s: Sources) -> DataFrame:
    moves = s.fresh("Cuenta.MovimientosCuenta", "FechaMovimiento")
    days = daily_balance(moves, "NumeroCuenta", "FechaMovimiento", "ImporteMovimiento", "SaldoDespuesMovimiento")
    return days.withColumn("NumeroCuenta", clean_text("NumeroCuenta")).withColumnsRenamed(
        {"NumeroCuenta": "Numero Cuenta", "FechaMovimiento": "Fecha"})


def credit(s: Sources) -> DataFrame:
    products = s("Producto.CatalogoProductos", "ProductoID, NombreProducto")
    offices = s("Organizacion.Sucursales").select(q("SucursalID").alias("SucursalGestion"), "NombreSucursal")
    people = _people(s, "Deudor")
    layout = """= WWI Credito ID, NumeroContrato, = Tipo Credito, PersonaID > Cliente ID, DeudorNombre > Nombre Cliente,
        NombreProducto > Producto, ImporteConcedido, ImportePendiente, TINAplicado, TAEAplicado, TipoInteres, PlazoMeses,
        ImporteCuota, FechaFormalizacion, FechaPrimerVencimiento, FechaUltimoVencimiento, = Fecha Liquidacion,
        EstadoPrestamo, = Valor Tasacion Garantia, = LTV Porcentaje, = Tiene Seguro Vida, = Sucursal Gestion"""

    def subtype(table: str, ident: str, part: str) -> DataFrame:
        rows = s.fresh(table, ident, part).join(products, "ProductoID")
        return rows.join(people, q("PersonaID") == q("DeudorID"), "left")

    loans = subtype("Credito.Prestamos", "PrestamoID", "loan").join(offices, "SucursalGestion", "left")
    mortgages = subtype("Credito.PrestamosHipotecarios", "PrestamoHipotecarioID", "mortgage")
    return arrange(loans, layout, {
        "WWI Credito ID": _shifted("PrestamoID", s.offset("loan")), "Tipo Credito": F.lit(LOAN),
        "Fecha Liquidacion": q("FechaLiquidacion"), "Valor Tasacion Garantia": nothing("decimal(18,2)"),
        "LTV Porcentaje": nothing("decimal(5,2)"), "Tiene Seguro Vida": F.lit(False), "Sucursal Gestion": clean_text("NombreSucursal"),
    }).unionByName(arrange(mortgages, layout, {
        "WWI Credito ID": _shifted("PrestamoHipotecarioID", s.offset("mortgage")), "Tipo Credito": F.lit(MORTGAGE),
        "Fecha Liquidacion": nothing("date"), "Valor Tasacion Garantia": q("ValorTasacionInmueble"),
        "LTV Porcentaje": q("LTVPorcentaje"), "Tiene Seguro Vida": F.coalesce(q("TieneSeguroVida"), F.lit(False)),
        "Sucursal Gestion": nothing("string"),
    }))


def instalment(s: Sources) -> DataFrame:
    return arrange(s.fresh("Credito.CuotasPrestamo", "CuotaPrestamoID"), """CuotaPrestamoID > WWI Cuota ID, NumeroContrato,
        NumeroCuota, FechaVencimiento, ImporteCuota, ImporteCapital, ImporteIntereses, ImporteComisiones, CapitalPendiente,
        FechaPago, ImportePagado, EstadoCuota, DiasRetraso""")


def transfer(s: Sources) -> DataFrame:
    layout = """= WWI Transferencia ID, NumeroOperacion, = Tipo Transferencia, CuentaOrigen, {to} > Cuenta Destino,
        = Nombre Beneficiario, = Entidad Destino, = Pais Destino, ImporteTransferencia, Concepto, FechaOperacion, FechaValor,
        = Comision Aplicada, EstadoTransferencia, = Canal Operacion, = Es Pago Recurrente, = Es SEPA"""
    text = nothing("string")
    common = {"Entidad Destino": text, "Pais Destino": text, "Canal Operacion": text, "Nombre Beneficiario": text,
              "Comision Aplicada": money(F.lit(0)), "Es Pago Recurrente": F.lit(False), "Es SEPA": F.lit(False)}

    def subtype(table: str, ident: str, part: str, tag: str, to: str, **given) -> DataFrame:
        own = {name.replace("_", " "): column for name, column in given.items()}
        fixed = {"WWI Transferencia ID": _shifted(ident, s.offset(part)), "Tipo Transferencia": F.lit(tag)}
        return arrange(s.fresh(table, ident, part), layout.format(to=to), {**common, **fixed, **own})

    internal = subtype("Transferencia.TransferenciasInternas", "TransferenciaInternaID", "internal", "INTERNA", "CuentaDestino",
                       Canal_Operacion=clean_text("CanalOperacion"))
    external = subtype("Transferencia.TransferenciasExternas", "TransferenciaExternaID", "external", "EXTERNA", "IBANDestino",
                       Canal_Operacion=clean_text("CanalOperacion"), Nombre_Beneficiario=clean_text("BeneficiarioNombre"),
                       Entidad_Destino=clean_text("EntidadDestino"), Comision_Aplicada=q("ComisionAplicada"))
    sepa = subtype("Transferencia.TransferenciasSEPA", "TransferenciaSEPAID", "sepa", "SEPA", "IBANDestino",
                   Nombre_Beneficiario=clean_text("BeneficiarioNombre"), Pais_Destino=clean_text("PaisDestino"),
                   Comision_Aplicada=q("ComisionAplicada"), Es_SEPA=F.lit(True))
    return internal.unionByName(external).unionByName(sepa)


def provision(s: Sources) -> DataFrame:
    classes = s("Riesgo.ClasificacionesRiesgo", "ClasificacionRiesgoID, NombreClasificacion, PorcentajeProvision")
    return arrange(s.fresh("Riesgo.ProvisionesContables", "ProvisionID").join(classes, "ClasificacionRiesgoID"),
                   """ProvisionID > WWI Provision ID, NumeroContrato, FechaProvision, TipoProvision, ImporteProvisionado,
                   ImporteRecuperado, SaldoProvision, NombreClasificacion > Clasificacion Riesgo, PorcentajeProvision""")


def risk_report(s: Sources) -> DataFrame:
    declared = s("Riesgo.DeclaracionesCIRBE", "DeclaracionCIRBEID, PersonaID, PeriodoDeclaracion, FechaDeclaracion, ClasificacionRiesgo")
    lenders = s("Riesgo.EntidadesFinancieras", "EntidadFinancieraID, NombreEntidad")
    rows = (
        s.fresh("Riesgo.OperacionesCIRBE", "OperacionCIRBEID")
        .join(declared, "DeclaracionCIRBEID")
        .join(lenders, "EntidadFinancieraID")
        .join(_people(s, "Deudor"), q("PersonaID") == q("DeudorID"), "left")
    )
    return arrange(rows, """OperacionCIRBEID > WWI CIRBE ID, PersonaID > Cliente ID, DeudorNombre > Nombre Cliente,
        PeriodoDeclaracion, FechaDeclaracion, NombreEntidad > Entidad Financiera, TipoOperacion, NaturalezaOperacion,
        ImporteOperacion, SaldoVivo, TipoGarantia, EsOperacionDudosa, ClasificacionRiesgo""")


def guarantee(s: Sources) -> DataFrame:
    rows = s.fresh("Credito.Avales", "AvalID").join(_people(s, "Persona"), q("AvaladorPersonaID") == q("PersonaID"), "left")
    return arrange(rows, """AvalID > WWI Aval ID, NumeroContrato, NumeroAval, AvaladorPersonaID > Cliente Avalista ID,
        = Nombre Avalista, TipoAval, ImporteAvalado, PorcentajeCobertura, FechaConstitucion, FechaVencimiento, EstadoAval""",
        {"Nombre Avalista": clean_text(F.coalesce(q("AvaladorNombre"), q("PersonaNombre")))})


LOADS = {
    load.target: load
    for load in (
        CleanLoad("Centro_Staging", centre, "WWI Centro ID"),
        CleanLoad("EntidadFinanciera_Staging", institution, "WWI Entidad ID"),
        CleanLoad("ClasificacionRiesgo_Staging", risk_class, "WWI Clasificacion ID"),
        CleanLoad("Producto_Staging", product, "WWI Producto ID"),
        CleanLoad("Cliente_Staging", customer, "WWI Cliente ID", ranges=CUSTOMERS),
        CleanLoad("PerfilRiesgo_Staging", risk_profile, "WWI Cliente ID"),
        CleanLoad("Garantia_Staging", collateral, "WWI Garantia ID"),
        CleanLoad("Empleado_Staging", employee, "WWI Empleado ID"),
        CleanLoad("Cuenta_Staging", account, "WWI Cuenta ID", ranges=ACCOUNTS),
        CleanLoad("Movimiento_Staging", movement, "WWI Movimiento ID"),
        CleanLoad("SaldoDiario_Staging", balance, "Fecha", by="date"),
        CleanLoad("Credito_Staging", credit, "WWI Credito ID", ranges=CREDITS),
        CleanLoad("Cuota_Staging", instalment, "WWI Cuota ID"),
        CleanLoad("Transferencia_Staging", transfer, "WWI Transferencia ID", ranges=TRANSFERS),
        CleanLoad("Provision_Staging", provision, "WWI Provision ID"),
        CleanLoad("CIRBE_Staging", risk_report, "WWI CIRBE ID"),
        CleanLoad("Aval_Staging", guarantee, "WWI Aval ID"),
    )
}
