"""Bank and wholesale raw tables derived from the given tables.

The texts use only SQL that Spark and the oracle engine read alike, so both start from the same rows.
Every table is derived from a whole given table and grows with it.
"""

from __future__ import annotations

from bodega.functions.identifiers import DNI_LETTERS
from bodega.queries.base import Tables


def iban(ident: str) -> str:
    """A 24-character account number; every 25th has wrong control digits."""
    check = f"lpad(cast(98 - (({ident}) * 1000000 + 142800) % 97 as string), 2, '0')"
    return (f"('ES' || case when ({ident}) % 25 = 0 then '00' else {check} end || "
            f"lpad(cast({ident} as string), 20, '0'))")


def dni(ident: str) -> str:
    """Eight digits and a letter; every 33rd letter is wrong."""
    number = f"((({ident}) * 7919 + 12345678) % 100000000)"
    shift = f"(case when ({ident}) % 33 = 0 then 1 else 0 end)"
    return (f"(lpad(cast({number} as string), 8, '0') || "
            f"substr('{DNI_LETTERS}', cast(({number} + {shift}) % 23 as int) + 1, 1))")


def email(ident: str) -> str:
    """Every 20th lacks the at sign."""
    return f"('  Client' || cast({ident} as string) || case when ({ident}) % 20 = 0 then '' else '@' end || 'Mail.ES ')"


def phone(ident: str) -> str:
    """Nine digits from 6; every 20th has eight."""
    return (f"case when ({ident}) % 20 = 0 then '6' || lpad(cast({ident} as string), 7, '0') "
            f"else '6' || lpad(cast({ident} as string), 8, '0') end")


def postal(ident: str) -> str:
    """Five digits; every 25th has four."""
    return f"case when ({ident}) % 25 = 0 then '2800' else lpad(cast(({ident}) % 53000 as string), 5, '0') end"


def money(expr: str) -> str:
    return f"cast({expr} as decimal(18,2))"


def day(base: str, shift: str) -> str:
    return f"date '{base}' + cast({shift} as int)"


def contract(prefix: str, ident: str) -> str:
    return f"('{prefix}-' || lpad(cast({ident} as string), 12, '0'))"


def one_of(parent: str, number: str) -> str:
    """The id of a row of the whole parent table (ids are 1 to its number of rows)."""
    return f"({number}) % (select count(*) from {{{parent}}}) + 1"


C, S, P, O, E = "c_custkey + 1", "s_suppkey + 1", "p_partkey + 1", "o_orderkey + 1", "event_id + 1"
LINE = "l_orderkey * 10 + l_linenumber"
LOAN_STATE = ("case when o_orderkey % 40 = 0 then 'Cancelado' when o_orderstatus = 'F' then 'Dudoso' "
              "when o_orderstatus = 'O' then 'Vencido' else 'Vigente' end")

RAW = {
    "Cliente.Segmentos": """select r_regionkey + 1 as SegmentoID, 'S' || cast(r_regionkey as string) as CodigoSegmento,
        ' ' || lower(r_name) || ' ' as NombreSegmento, r_regionkey + 1 as NivelRiesgo from {region}""",
    "Cliente.Personas": f"""select {C} as PersonaID, {dni(C)} as NumeroDocumento, ' ' || lower(substr(c_name, 1, 8)) as Nombre,
        substr(c_name, 10) as Apellido1, case when c_custkey % 4 = 0 then null else lower(c_mktsegment) end as Apellido2,
        {day('1940-01-01', 'c_custkey % 20000')} as FechaNacimiento, case when c_custkey % 2 = 0 then 'f' else 'M ' end as Sexo,
        'nation_' || cast(c_nationkey as string) as Nacionalidad, {email(C)} as Email, {phone(C)} as TelefonoMovil,
        case when c_custkey % 3 = 0 then null else ' 910000000' end as TelefonoFijo, c_nationkey % 5 + 1 as SegmentoID,
        c_acctbal >= 0 as EsClienteActivo, {day('2013-01-01', 'c_custkey % 3650')} as FechaAlta,
        case when c_custkey % 120 = 0 then date '2012-06-01' end as FechaBaja from {{customer}}""",
    "Cliente.PersonasJuridicas": f"""select {S} as PersonaJuridicaID, 'b' || lpad(cast(s_suppkey as string), 8, '0') as CIF,
        lower(s_name) as RazonSocial, 'sl ' as FormaJuridica, {day('1990-01-01', 's_suppkey % 9000')} as FechaConstitucion,
        cast(1000 + s_suppkey % 9000 as string) as CNAE, case when s_suppkey % 20 = 0 then null else {email(S)} end as Email,
        {phone(S)} as TelefonoContacto, s_nationkey % 5 + 1 as SegmentoID, s_acctbal >= 0 as EsClienteActivo,
        {day('2013-01-01', 's_suppkey % 3650')} as FechaAlta, cast(null as date) as FechaBaja from {{supplier}}""",
    "Cliente.SegmentacionComercial": f"""select {C} as PersonaID, cast(null as bigint) as PersonaJuridicaID,
        lower(c_mktsegment) as SubSegmento, 'oro' as ClasificacionComercial, ' alto' as PotencialNegocio,
        date '2024-01-01' as FechaSegmentacion from {{customer}} where c_acctbal > 0
        union all select cast(null as bigint), {S}, 'empresa', 'plata', 'medio ', date '2024-01-01' from {{supplier}}""",
    "Cliente.ScoreCrediticio": f"""select {C} as PersonaID, cast(300 + c_custkey % 550 as int) as ScoreCredito,
        case when c_acctbal < 0 then 'alto ' else 'bajo' end as NivelRiesgo, cast(c_custkey % 100 as decimal(5,2)) as ProbabilidadImpago,
        case when c_custkey % 5 = 0 then null else {money('c_acctbal')} end as LimiteEndeudamiento,
        {day('2024-01-01', 'c_custkey % 28')} as FechaCalculoScore, 'interna' as FuenteScore, 'modelo v1' as ModeloScoring
        from {{customer}}""",
    "Cliente.PerfilTransaccional": f"""select user_id + 1 as PersonaID, cast(count(*) as int) as NumeroTransaccionesMes,
        max({money('value')}) as ImportePromedioTransaccion, sum({money('value')}) as VolumenMensualOperaciones,
        cast(sum(case when event_type = 'purchase' then 1 else 0 end) as int) as NumeroTransferenciasInternacionales,
        count(*) > 70 as TieneOperativaInusual, cast(max(ts) as date) as FechaUltimaActualizacion from {{events}} group by user_id""",
    "Producto.TiposProducto": """select distinct length(p_type) * 1000 + ascii(p_type) as TipoProductoID,
        lower(p_type) as NombreTipoProducto from {part}""",
    "Producto.CategoriasProducto": """select distinct cast(substr(p_brand, 7) as int) as CategoriaProductoID,
        p_brand as NombreCategoria from {part}""",
    "Producto.CatalogoProductos": f"""select {P} as ProductoID, contract_p as CodigoProducto, NombreProducto,
        p_type as Descripcion, length(p_type) * 1000 + ascii(p_type) as TipoProductoID, cast(substr(p_brand, 7) as int) as CategoriaProductoID,
        TAE, TIN, Comision, {money('p_size')} as ImporteMinimo, {money('p_retailprice')} as ImporteMaximo, p_size as PlazoMinimoDias,
        p_size * 2 as PlazoMaximoDias, p_size > 25 as RequiereGarantia, 18 as EdadMinima, 75 as EdadMaxima,
        p_size % 5 > 0 as EsComercializable, {day('2015-01-01', 'p_size')} as FechaLanzamiento, cast(null as date) as FechaRetiro
        from (select *, {contract('p', P)} as contract_p, lower(p_name) as NombreProducto,
            case when p_partkey % 9 = 0 then null else cast(p_size as decimal(5,3)) end as TAE, cast(p_size as decimal(5,3)) as TIN,
            case when p_partkey % 7 = 0 then null else {money('p_size')} end as Comision from {{part}}) t""",
    "Cuenta.TiposCuenta": "select r_regionkey + 1 as TipoCuentaID, 'cuenta ' || r_name as NombreTipoCuenta from {region}",
    "Cuenta.CuentasCorrientes": f"""select {C} as CuentaCorrienteID, {iban(C)} as NumeroCuenta, c_custkey % 5 + 1 as TipoCuentaID,
        {one_of('part', 'c_custkey')} as ProductoID, {day('2014-01-01', 'c_custkey % 3000')} as FechaApertura, cast(null as date) as FechaCierre,
        {money('c_acctbal')} as SaldoActual, {money('c_acctbal')} as SaldoDisponible, cast(null as decimal(18,2)) as SaldoRetenido,
        {money('500')} as LimiteDescubierto, case when c_acctbal < 0 then 'bloqueada' else 'activa ' end as EstadoCuenta,
        {one_of('supplier', 'c_custkey')} as SucursalGestion from {{customer}}""",
    "Cuenta.CuentasAhorro": f"""select {S} as CuentaAhorroID, {iban('s_suppkey + 500000001')} as NumeroCuenta, s_suppkey % 5 + 1 as TipoCuentaID,
        {one_of('part', 's_suppkey * 7')} as ProductoID, {day('2014-01-01', 's_suppkey % 3000')} as FechaApertura, cast(null as date) as FechaCierre,
        {money('s_acctbal')} as SaldoActual, cast(1.250 as decimal(5,3)) as TAEAplicado, 'activa' as EstadoCuenta from {{supplier}}""",
    "Cuenta.CuentasNomina": f"""select {P} as CuentaNominaID, {iban('p_partkey + 700000001')} as NumeroCuenta, p_partkey % 5 + 1 as TipoCuentaID,
        {one_of('part', 'p_partkey * 3')} as ProductoID, {day('2014-01-01', 'p_size')} as FechaApertura, cast(null as date) as FechaCierre,
        {money('p_retailprice')} as SaldoActual, {money('p_size')} as SaldoDisponible, p_size % 2 = 0 as TieneNominaDomiciliada,
        'activa' as EstadoCuenta from {{part}}""",
    "Cuenta.TitularesCuenta": f"""select {iban(C)} as NumeroCuenta, {C} as PersonaID, 'Titular' as TipoTitularidad from {{customer}}
        union all select {iban(C)}, {C} + 1, 'Cotitular' from {{customer}}""",
    "Cuenta.MovimientosCuenta": f"""select {E} as MovimientoCuentaID, ' ' || lower({iban('user_id + 1')}) as NumeroCuenta,
        cast(ts as date) as FechaMovimiento, cast(ts as date) + 1 as FechaValor, event_type as TipoMovimiento, props as Concepto,
        case when event_type in ('error', 'view') then -{money('value')} else {money('value')} end as ImporteMovimiento,
        {money('value')} + cast(user_id as decimal(10,0)) as SaldoDespuesMovimiento, cast(null as string) as NumeroCuentaContrapartida,
        'app movil' as CanalOperacion, cast({one_of('supplier', 'user_id')} as int) as SucursalOperacion from {{events}}""",
    "Credito.Prestamos": f"""select {O} as PrestamoID, {contract('pre', O)} as NumeroContrato, o_custkey + 1 as PersonaID,
        {one_of('part', 'o_orderkey')} as ProductoID, {money('o_totalprice')} as ImporteConcedido, {money('o_totalprice')} as ImportePendiente,
        cast(6.000 as decimal(5,3)) as TINAplicado, cast(6.200 as decimal(5,3)) as TAEAplicado, 'fijo' as TipoInteres, 24 as PlazoMeses,
        {money('o_orderkey % 500 + 10')} as ImporteCuota, cast(o_orderdate as date) as FechaFormalizacion,
        cast(o_orderdate as date) + 30 as FechaPrimerVencimiento, cast(o_orderdate as date) + 720 as FechaUltimoVencimiento,
        cast(null as date) as FechaLiquidacion, {LOAN_STATE} as EstadoPrestamo, {one_of('supplier', 'o_orderkey')} as SucursalGestion from {{orders}}""",
    "Credito.PrestamosHipotecarios": f"""select {P} as PrestamoHipotecarioID, {contract('hip', P)} as NumeroContrato,
        {one_of('customer', 'p_partkey')} as PersonaID, {one_of('part', 'p_partkey * 7')} as ProductoID, {money('p_retailprice')} as ImporteConcedido,
        {money('p_retailprice')} as ImportePendiente, cast(1.800 as decimal(5,3)) as TINAplicado, cast(1.900 as decimal(5,3)) as TAEAplicado,
        'variable ' as TipoInteres, 300 as PlazoMeses, {money('p_size')} as ImporteCuota, {day('2016-01-01', 'p_size')} as FechaFormalizacion,
        {day('2016-02-01', 'p_size')} as FechaPrimerVencimiento, {day('2036-01-01', 'p_size')} as FechaUltimoVencimiento,
        'Vigente' as EstadoPrestamo, {money('p_retailprice')} * 2 as ValorTasacionInmueble,
        cast(40 + p_size as decimal(5,2)) as LTVPorcentaje, p_size % 2 = 0 as TieneSeguroVida from {{part}}""",
    "Credito.CuotasPrestamo": f"""select {LINE} as CuotaPrestamoID, {contract('pre', 'l_orderkey + 1')} as NumeroContrato,
        l_linenumber as NumeroCuota, cast(l_shipdate as date) as FechaVencimiento, {money('l_extendedprice')} as ImporteCuota,
        {money('l_quantity')} as ImporteCapital, {money('l_tax')} as ImporteIntereses, {money('0')} as ImporteComisiones,
        {money('l_extendedprice')} as CapitalPendiente, case when l_returnflag = 'A' then cast(l_shipdate as date) end as FechaPago,
        case when l_returnflag = 'A' then {money('l_extendedprice')} end as ImportePagado,
        case l_returnflag when 'A' then 'Pagada' when 'R' then 'Impagada' else 'Pendiente ' end as EstadoCuota,
        cast(case when l_returnflag = 'R' then l_partkey % 90 else 0 end as int) as DiasRetraso from {{lineitem}}""",
    "Credito.TiposGarantia": "select r_regionkey + 1 as TipoGarantiaID, lower(r_name) as NombreTipoGarantia from {region}",
    "Credito.Garantias": f"""select {P} as GarantiaID, {contract('hip', P)} as NumeroContrato, p_partkey % 5 + 1 as TipoGarantiaID,
        lower(p_name) as DescripcionGarantia, {money('p_retailprice')} as ValorTasacion, {day('2020-01-01', 'p_size')} as FechaTasacion,
        'tinsa' as EntidadTasadora, 'calle ' || p_name as DireccionGarantia, p_size % 2 = 0 as TieneSeguro,
        {day('2016-01-01', 'p_size')} as FechaConstitucion, cast(null as date) as FechaLiberacion, 'vigente' as EstadoGarantia from {{part}}""",
    "Credito.Avales": f"""select {C} as AvalID, {contract('pre', C)} as NumeroContrato, 'av-' || cast({C} as string) as NumeroAval,
        {C} + 1 as AvaladorPersonaID, case when c_custkey % 2 = 0 then null else ' aval ' || c_mktsegment end as AvaladorNombre,
        'solidario' as TipoAval, {money('abs(c_acctbal)')} as ImporteAvalado, cast(c_custkey % 100 as decimal(5,2)) as PorcentajeCobertura,
        {day('2018-01-01', 'c_custkey % 1000')} as FechaConstitucion,
        case when c_custkey % 3 = 0 then null else {day('2028-01-01', 'c_custkey % 1000')} end as FechaVencimiento, 'activo' as EstadoAval
        from {{customer}}""",
    "Transferencia.TransferenciasInternas": f"""select {E} as TransferenciaInternaID, {contract('tri', E)} as NumeroOperacion,
        {iban('user_id + 1')} as CuentaOrigen, {iban('user_id + 2')} as CuentaDestino, {money('value')} as ImporteTransferencia,
        event_type as Concepto, cast(ts as date) as FechaOperacion, cast(ts as date) as FechaValor, 'ejecutada' as EstadoTransferencia,
        'web ' as CanalOperacion from {{events}}""",
    "Transferencia.TransferenciasExternas": f"""select {O} as TransferenciaExternaID, {contract('tre', O)} as NumeroOperacion,
        {iban('o_custkey + 1')} as CuentaOrigen, 'es' || lpad(cast(o_orderkey as string), 18, '0') as IBANDestino, 'bbva' as EntidadDestino,
        {money('o_totalprice')} as ImporteTransferencia, o_orderpriority as Concepto, ' ana' as BeneficiarioNombre,
        cast(o_orderdate as date) as FechaOperacion, cast(o_orderdate as date) as FechaValor, {money('1.5')} as ComisionAplicada,
        'ejecutada' as EstadoTransferencia, 'app' as CanalOperacion from {{orders}}""",
    "Transferencia.TransferenciasSEPA": f"""select {S} as TransferenciaSEPAID, {contract('sepa', S)} as NumeroOperacion,
        {iban(S)} as CuentaOrigen, 'de89370400440532013000' as IBANDestino, 'de' as PaisDestino, {money('s_acctbal')} as ImporteTransferencia,
        'pago' as Concepto, s_name as BeneficiarioNombre, {day('2024-01-01', 's_suppkey % 300')} as FechaOperacion,
        {day('2024-01-02', 's_suppkey % 300')} as FechaValor, {money('2.5')} as ComisionAplicada, 'ejecutada' as EstadoTransferencia
        from {{supplier}}""",
    "Riesgo.EntidadesFinancieras": """select n_nationkey + 1 as EntidadFinancieraID, 'e' || cast(n_nationkey as string) as CodigoEntidad,
        ' banco ' || n_name as NombreEntidad, 'a000' as NIF, 'banco' as TipoEntidad, 'espana' as Pais, n_nationkey % 2 = 0 as EsVigente
        from {nation}""",
    "Riesgo.ClasificacionesRiesgo": """select r_regionkey + 1 as ClasificacionRiesgoID, 'r' || cast(r_regionkey as string) as CodigoClasificacion,
        case r_regionkey when 0 then 'Riesgo Normal' when 1 then 'Substandard' when 2 then 'Dudoso' else lower(r_name) end as NombreClasificacion,
        r_name as Descripcion, r_regionkey + 1 as NivelRiesgo, cast(r_regionkey * 25 as decimal(5,2)) as PorcentajeProvision,
        true as EsVigente from {region}""",
    "Riesgo.DeclaracionesCIRBE": f"""select {C} as DeclaracionCIRBEID, {C} as PersonaID, date '2024-05-31' as FechaDeclaracion,
        '2024-05' as PeriodoDeclaracion, {money('abs(c_acctbal)')} as RiesgoDirecto,
        case c_custkey % 3 when 0 then 'Normal' when 1 then 'Substandard' else 'Dudoso' end as ClasificacionRiesgo from {{customer}}""",
    "Riesgo.OperacionesCIRBE": f"""select {O} as OperacionCIRBEID, o_custkey + 1 as DeclaracionCIRBEID, o_orderkey % 25 + 1 as EntidadFinancieraID,
        'prestamo' as TipoOperacion, 'financiacion' as NaturalezaOperacion, {money('o_totalprice')} as ImporteOperacion,
        {money('o_totalprice')} as SaldoVivo, cast(null as string) as TipoGarantia, o_orderstatus = 'F' as EsOperacionDudosa from {{orders}}""",
    "Riesgo.ProvisionesContables": f"""select {O} as ProvisionID, {contract('pre', O)} as NumeroContrato, cast(o_orderdate as date) as FechaProvision,
        'especifica' as TipoProvision, {money('o_totalprice')} as ImporteProvisionado, {money('0')} as ImporteRecuperado,
        {money('o_totalprice')} as SaldoProvision, o_orderkey % 5 + 1 as ClasificacionRiesgoID from {{orders}}""",
    "Organizacion.ZonasGeograficas": "select r_regionkey + 1 as ZonaGeograficaID, lower(r_name) as NombreZona from {region}",
    "Organizacion.Departamentos": "select r_regionkey + 1 as DepartamentoID, 'dep ' || r_name as NombreDepartamento from {region}",
    "Organizacion.Sucursales": f"""select {S} as SucursalID, 'suc-' || cast(s_suppkey as string) as CodigoSucursal, ' of ' || s_name as NombreSucursal,
        'calle ' || cast(s_suppkey as string) as DireccionCompleta, {postal(S)} as CodigoPostal, 'madrid' as Localidad, 'madrid ' as Provincia,
        case when s_suppkey % 6 = 0 then null else s_suppkey % 6 end as ZonaGeograficaID, ' 912345678' as Telefono, {email(S)} as Email,
        {S} as DirectorSucursal, cast(s_suppkey % 40 as int) as NumeroEmpleados, {day('2000-01-01', 's_suppkey')} as FechaApertura,
        cast(null as date) as FechaCierre, 'abierta' as EstadoSucursal from {{supplier}}""",
    "Organizacion.Empleados": f"""select {S} as EmpleadoID, 'emp-' || cast(s_suppkey as string) as NumeroEmpleado, {S} as PersonaID,
        s_suppkey % 7 + 1 as DepartamentoID, {one_of('supplier', 's_suppkey * 3')} as SucursalID, 'gestor' as Puesto, 'n' || cast(s_nationkey as string) as Categoria,
        case when s_suppkey % 10 = 0 then null else {one_of('supplier', 's_suppkey * 7')} end as SupervisorID, {day('2010-01-01', 's_suppkey')} as FechaAlta,
        cast(null as date) as FechaBaja, 'activo' as EstadoEmpleado from {{supplier}}""",
    "Application.Countries": """select r_regionkey as CountryID, lower(r_name) as CountryName, 'cont ' || r_name as Continent,
        'reg' as Region, 'sub ' as Subregion from {region}""",
    "Application.StateProvinces": """select n_nationkey as StateProvinceID, lower(n_name) as StateProvinceName, 'ter ' || n_name as SalesTerritory,
        n_regionkey as CountryID from {nation}""",
    "Application.Cities": f"""select {S} as CityID, ' ' || lower(s_name) as CityName, s_nationkey as StateProvinceID, cast(null as binary) as Location,
        case when s_suppkey % 4 = 0 then null else s_suppkey * 1000 end as LatestRecordedPopulation, date '2013-01-01' as ValidFrom,
        date '9999-12-31' as ValidTo from {{supplier}}""",
    "Application.People": f"""select {S} as PersonID, lower(s_name) as FullName, ' ' || upper(s_name) as PreferredName, s_acctbal > 0 as IsEmployee,
        s_nationkey % 2 = 0 as IsSalesperson, cast(null as binary) as Photo, date '2013-01-01' as ValidFrom, date '9999-12-31' as ValidTo
        from {{supplier}}""",
    "Application.PaymentMethods": """select r_regionkey + 1 as PaymentMethodID, 'check ' || lower(r_name) as PaymentMethodName,
        date '2013-01-01' as ValidFrom, date '9999-12-31' as ValidTo from {region}""",
    "Application.TransactionTypes": """select n_nationkey + 1 as TransactionTypeID, 'type ' || lower(n_name) as TransactionTypeName,
        date '2013-01-01' as ValidFrom, date '9999-12-31' as ValidTo from {nation}""",
    "Sales.Customers": f"""select {C} as CustomerID, lower(c_name) as CustomerName, c_custkey - c_custkey % 10 + 1 as BillToCustomerID,
        c_nationkey % 6 + 1 as CustomerCategoryID, case when c_custkey % 3 = 0 then null else c_nationkey + 1 end as BuyingGroupID,
        {one_of('supplier', 'c_custkey')} as PrimaryContactPersonID, case when c_custkey % 7 = 0 then null else ' 28 ' || {postal(C)} || ' 123456' end as PostalPostalCode,
        date '2013-01-01' as ValidFrom, date '9999-12-31' as ValidTo from {{customer}}""",
    "Sales.CustomerCategories": "select r_regionkey + 1 as CustomerCategoryID, lower(r_name) as CustomerCategoryName from {region}",
    "Sales.BuyingGroups": "select n_nationkey + 1 as BuyingGroupID, lower(n_name) as BuyingGroupName from {nation}",
    "Warehouse.Colors": "select n_nationkey + 1 as ColorID, 'color ' || n_name as ColorName from {nation}",
    "Warehouse.PackageTypes": "select r_regionkey + 1 as PackageTypeID, 'pack ' || lower(r_name) as PackageTypeName from {region}",
    "Warehouse.StockItems": f"""select {P} as StockItemID, lower(p_name) as StockItemName, case when p_size > 40 then null else p_size % 30 end as ColorID,
        p_size % 5 + 1 as OuterPackageID, p_partkey % 5 + 1 as UnitPackageID, case when p_size % 3 = 0 then null else p_brand end as Brand,
        case when p_size % 2 = 0 then null else cast(p_size as string) end as Size, p_size as LeadTimeDays, p_size % 12 + 1 as QuantityPerOuter,
        p_size % 4 = 0 as IsChillerStock, cast(p_partkey as string) as Barcode, cast(15.000 as decimal(18,3)) as TaxRate,
        {money('p_retailprice')} as UnitPrice, {money('p_retailprice')} * 2 as RecommendedRetailPrice,
        cast(p_size as decimal(18,3)) as TypicalWeightPerUnit, cast(null as binary) as Photo, date '2013-01-01' as ValidFrom,
        date '9999-12-31' as ValidTo from {{part}}""",
    "Warehouse.StockItemHoldings": f"""select {P} as StockItemID, p_size as QuantityOnHand, ' l-' || cast(p_size as string) as BinLocation,
        p_size + 1 as LastStocktakeQuantity, {money('p_retailprice')} as LastCostPrice, 10 as ReorderLevel, 100 as TargetStockLevel from {{part}}""",
    "Warehouse.StockItemTransactions": f"""select l_shipdate as TransactionOccurredWhen, l_partkey + 1 as StockItemID,
        case when l_linenumber = 1 then l_suppkey + 1 end as CustomerID, case when l_linenumber > 1 then l_suppkey + 1 end as SupplierID,
        l_linenumber as TransactionTypeID, {LINE} as StockItemTransactionID, l_orderkey as InvoiceID, cast(null as bigint) as PurchaseOrderID,
        cast(-l_quantity as int) as Quantity from {{lineitem}}""",
    "Sales.Orders": f"""select {O} as OrderID, o_custkey + 1 as CustomerID, {one_of('supplier', 'o_orderkey')} as SalespersonPersonID,
        case when o_orderstatus = 'P' then null else {one_of('supplier', 'o_orderkey * 3')} end as PickedByPersonID, cast(null as bigint) as BackorderOrderID,
        o_orderdate as OrderDate, case when o_orderstatus = 'F' then o_orderdate end as PickingCompletedWhen from {{orders}}""",
    "Sales.OrderLines": f"""select l_orderkey + 1 as OrderID, l_partkey + 1 as StockItemID, l_returnflag || ' line ' as Description,
        l_linenumber % 6 + 1 as PackageTypeID, cast(l_quantity as int) as Quantity, {money('l_extendedprice')} as UnitPrice,
        cast(l_tax * 100 as decimal(18,3)) as TaxRate from {{lineitem}}""",
    "Purchasing.PurchaseOrders": f"""select {O} as PurchaseOrderID, {one_of('supplier', 'o_custkey')} as SupplierID, o_orderdate as OrderDate,
        o_orderstatus = 'F' as IsOrderFinalized from {{orders}}""",
    "Purchasing.PurchaseOrderLines": """select l_orderkey + 1 as PurchaseOrderID, l_partkey + 1 as StockItemID, cast(l_quantity as int) as OrderedOuters,
        cast(l_quantity as int) - 1 as ReceivedOuters, l_linenumber % 5 + 1 as PackageTypeID from {lineitem}""",
    "Purchasing.Suppliers": f"""select {S} as SupplierID, lower(s_name) as SupplierName, s_nationkey % 6 + 1 as SupplierCategoryID,
        {one_of('supplier', 's_suppkey * 7')} as PrimaryContactPersonID, 'ref' || cast(s_suppkey as string) as SupplierReference, s_nationkey as PaymentDays,
        {postal(S)} as PostalPostalCode, date '2013-01-01' as ValidFrom, date '9999-12-31' as ValidTo from {{supplier}}""",
    "Purchasing.SupplierCategories": "select r_regionkey + 1 as SupplierCategoryID, lower(r_name) as SupplierCategoryName from {region}",
    "Sales.Invoices": f"""select {O} as InvoiceID, o_custkey + 1 as CustomerID, o_custkey - o_custkey % 10 + 1 as BillToCustomerID,
        {one_of('supplier', 'o_orderkey')} as SalespersonPersonID, o_orderdate as InvoiceDate, case when o_orderstatus = 'F' then o_orderdate end as ConfirmedDeliveryTime
        from {{orders}}""",
    "Sales.InvoiceLines": f"""select l_orderkey + 1 as InvoiceID, l_partkey + 1 as StockItemID, l_linestatus || ' sold' as Description,
        l_linenumber % 5 + 1 as PackageTypeID, cast(l_quantity as int) as Quantity, {money('l_extendedprice')} as UnitPrice,
        cast(l_tax * 100 as decimal(18,3)) as TaxRate, {money('l_quantity')} as LineProfit, {money('l_tax')} as TaxAmount,
        {money('l_extendedprice')} as ExtendedPrice from {{lineitem}}""",
    "Sales.CustomerTransactions": f"""select {O} as CustomerTransactionID, o_custkey + 1 as CustomerID, o_orderkey % 30 + 1 as TransactionTypeID,
        o_orderkey % 6 + 1 as PaymentMethodID, {O} as InvoiceID, o_orderdate as TransactionDate, {money('o_totalprice')} as TransactionAmount,
        {money('o_orderkey % 100')} as TaxAmount, {money('0')} as OutstandingBalance, o_orderstatus = 'F' as IsFinalized from {{orders}}""",
    "Purchasing.SupplierTransactions": f"""select {LINE} as SupplierTransactionID, l_suppkey + 1 as SupplierID, l_linenumber as TransactionTypeID,
        l_linenumber % 6 + 1 as PaymentMethodID, l_orderkey + 1 as PurchaseOrderID, l_shipdate as TransactionDate,
        {money('l_extendedprice')} as TransactionAmount, {money('l_tax')} as TaxAmount, {money('l_quantity')} as OutstandingBalance,
        l_returnflag = 'R' as IsFinalized from {{lineitem}}""",
}


def raw(t: Tables):
    """Reader of the derived raw tables."""
    return lambda name: t.sql(RAW[name])


def raw_sql(*names: str) -> str:
    """CTE list of derived raw tables for an oracle text."""
    return ",\n".join(f'"{n}" as ({RAW[n]})' for n in names).replace("{", "").replace("}", "")
