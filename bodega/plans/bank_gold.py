"""Bank, clean to star schema: 9 dimensions and 8 facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.functions.amounts import money
from bodega.operators.facts import snapshot_key
from bodega.operators.joins import bridge, detail_measures, q, resolve
from bodega.plans.bank_silver import CREDITS, TRANSFERS
from bodega.plans.star import Dimension, FactLoad, Lookup, Star, day_keys, fact_rows

CUSTOMER, ACCOUNT, PRODUCT = "Dimension.Cliente", "Dimension.Cuenta", "Dimension.Producto"
RISK_CLASS, INSTITUTION = "Dimension.ClasificacionRiesgo", "Dimension.EntidadFinanciera"


# Instalment states that are counted.
PENDING, UNPAID = "PENDIENTE", "IMPAGADA"

DIMENSIONS = {
    d.target: d
    for d in (
        Dimension("Dimension.Centro", "Centro_Staging", "Centro Key", ("WWI Centro ID",),
                  {"Nombre Centro": None, "Estado Centro": None, "Numero Empleados": 0},
                  drop=("Telefono", "Email", "Director Centro", "Centro Padre"), add={"Centro Padre Key": "int"}, ends=True),
        Dimension(INSTITUTION, "EntidadFinanciera_Staging", "Entidad Financiera Key", ("WWI Entidad ID",), against_open=False),
        Dimension(RISK_CLASS, "ClasificacionRiesgo_Staging", "Clasificacion Riesgo Key", ("Codigo Clasificacion",),
                  drop=("WWI Clasificacion ID",), versioned=False),
        Dimension(PRODUCT, "Producto_Staging", "Producto Key", ("WWI Producto ID",),
                  {"TAE": 0, "TIN": 0, "Es Comercializable": None},
                  drop=("Importe Minimo", "Importe Maximo", "Plazo Minimo Dias", "Plazo Maximo Dias", "Edad Minima", "Edad Maxima"), ends=True),
        Dimension(CUSTOMER, "Cliente_Staging", "Cliente Key", ("WWI Cliente ID",),
                  {"Segmento": "", "Provincia": "", "Es Cliente Activo": None}, drop=("Telefono Fijo", "Clasificacion Comercial"),
                  ends=True),
        Dimension("Dimension.PerfilRiesgo", "PerfilRiesgo_Staging", "Perfil Riesgo Key", ("WWI Cliente ID",),
                  {"Score Credito": 0, "Nivel Riesgo": ""},
                  drop=("Fecha Calculo Score", "Fuente Score", "Importe Promedio Transaccion",
                        "Numero Transferencias Internacionales", "Fecha Actualizacion"), ends=True),
        Dimension("Dimension.Garantia", "Garantia_Staging", "Garantia Key", ("WWI Garantia ID",), against_open=False,
                  drop=("Numero Contrato", "Direccion Garantia", "Fecha Constitucion", "Fecha Liberacion")),
        Dimension("Dimension.Empleado", "Empleado_Staging", "Empleado Key", ("WWI Empleado ID",),
                  {"Puesto": None, "Estado Empleado": None}, drop=("Telefono",), ends=True),
        Dimension(ACCOUNT, "Cuenta_Staging", "Cuenta Key", ("WWI Cuenta ID",), {"Estado Cuenta": None},
                  drop=("Cliente ID", "Saldo Actual", "Saldo Disponible", "Saldo Retenido", "Limite Descubierto"),
                  lookup=Lookup("Cliente Key", CUSTOMER, ("Cliente ID", "WWI Cliente ID"), "Cliente Key"), ends=True),
    )
}


def _account_and_customer(g: Star, rows: DataFrame, number: str, account_key: str = "Cuenta Key") -> DataFrame:
    return g.key(rows, ACCOUNT, (number, "Numero Cuenta"), {account_key: "Cuenta Key", "Cliente Key": "Cliente Key"})


def _holder(g: Star, rows: DataFrame, column: str = "Cliente Key") -> DataFrame:
    """Customer key of a contract: contract -> credit -> current customer version."""
    contracts = bridge(g.staging("Credito_Staging"), g.current(CUSTOMER), {"Cliente ID": "WWI Cliente ID"}, "Numero Contrato", "Cliente Key")
    return resolve(rows, contracts, {"Numero Contrato": "Numero Contrato"}, {column: "Cliente Key"}, single=False)


def movement(g: Star) -> DataFrame:
    rows = _account_and_customer(g, g.fresh("Movimiento_Staging", "WWI Movimiento ID"), "Numero Cuenta")
    return fact_rows(rows, """= Fecha Movimiento Key, = Fecha Valor Key, Cuenta Key, Cliente Key, Tipo Movimiento, Concepto,
        Importe Movimiento, Saldo Despues Movimiento, Canal Operacion, = Centro Key, WWI Movimiento ID""", {
        **day_keys(Fecha_Movimiento_Key="Fecha Movimiento", Fecha_Valor_Key="Fecha Valor"), "Centro Key": F.lit(0),
    })


def account_balance(g: Star) -> DataFrame:
    rows = _account_and_customer(g, g.fresh("SaldoDiario_Staging", "Fecha"), "Numero Cuenta")
    return fact_rows(rows, """= Fecha Key, Cuenta Key, Cliente Key, = Producto Key, Saldo Apertura, Saldo Cierre, Saldo Promedio,
        Numero Movimientos, Importe Total Entradas, Importe Total Salidas""", {
        **day_keys(Fecha_Key="Fecha"), "Producto Key": F.lit(0),
    })


def credit(g: Star) -> DataFrame:
    state, zero = q("Estado Cuota"), money(F.lit(0))
    plan = detail_measures(g.staging("Cuota_Staging"), "Numero Contrato", {
        "_pending": F.count_if(state == PENDING), "_unpaid": F.count_if(state == UNPAID), "_delay": F.max(q("Dias Retraso")),
    })
    rows = g.fresh("Credito_Staging", "WWI Credito ID")
    rows = g.key(rows, CUSTOMER, ("Cliente ID", "WWI Cliente ID"), {"Cliente Key": "Cliente Key"})
    rows = g.key(rows, PRODUCT, ("Producto", "Nombre Producto"), {"Producto Key": "Producto Key"})
    return fact_rows(rows.join(plan, "Numero Contrato", "left"), """= Fecha Formalizacion Key, = Fecha Snapshot Key, Cliente Key,
        Producto Key, = Garantia Key, = Centro Key, Numero Contrato, Tipo Credito, Importe Concedido, Importe Pendiente,
        = Capital Pendiente, = Intereses Devengados, TIN Aplicado, TAE Aplicado, Plazo Meses, = Cuotas Pendientes,
        = Cuotas Impagadas, = Dias Retraso Maximo, = Provision Dotada, Estado Prestamo, WWI Credito ID""", {
        **day_keys(Fecha_Formalizacion_Key="Fecha Formalizacion"), "Fecha Snapshot Key": snapshot_key(g.run_ts),
        "Garantia Key": F.lit(0), "Centro Key": F.lit(0), "Capital Pendiente": q("Importe Pendiente"),
        "Intereses Devengados": zero, "Provision Dotada": zero,
        "Cuotas Pendientes": F.coalesce(F.col("_pending"), F.lit(0)), "Cuotas Impagadas": F.coalesce(F.col("_unpaid"), F.lit(0)),
        "Dias Retraso Maximo": F.coalesce(F.col("_delay"), F.lit(0)),
    })


def instalment(g: Star) -> DataFrame:
    rows = _holder(g, g.fresh("Cuota_Staging", "WWI Cuota ID"))
    return fact_rows(rows, """= Fecha Vencimiento Key, = Fecha Pago Key, Cliente Key, Numero Contrato, Numero Cuota, Importe Cuota,
        Importe Capital, Importe Intereses, Importe Comisiones, Capital Pendiente, Importe Pagado, Estado Cuota, Dias Retraso,
        WWI Cuota ID""", day_keys(Fecha_Vencimiento_Key="Fecha Vencimiento", Fecha_Pago_Key="Fecha Pago"))


def transfer(g: Star) -> DataFrame:
    rows = g.fresh("Transferencia_Staging", "WWI Transferencia ID")
    rows = _account_and_customer(g, rows, "Cuenta Origen", "Cuenta Origen Key")
    return fact_rows(rows, """= Fecha Operacion Key, = Fecha Valor Key, Cuenta Origen Key, Cliente Key, Tipo Transferencia,
        Numero Operacion, Nombre Beneficiario, Pais Destino, Importe Transferencia, Comision Aplicada, Estado Transferencia,
        Canal Operacion, Es Pago Recurrente, Es SEPA, WWI Transferencia ID""",
        day_keys(Fecha_Operacion_Key="Fecha Operacion", Fecha_Valor_Key="Fecha Valor"))


def provision(g: Star) -> DataFrame:
    rows = _holder(g, g.fresh("Provision_Staging", "WWI Provision ID"))
    rows = g.key(rows, RISK_CLASS, ("Clasificacion Riesgo", "Nombre Clasificacion"),
                 {"Clasificacion Riesgo Key": "Clasificacion Riesgo Key"}, versioned=False)
    return fact_rows(rows, """= Fecha Provision Key, Cliente Key, Clasificacion Riesgo Key, Numero Contrato, Tipo Provision,
        Importe Provisionado, Importe Recuperado, Saldo Provision, Porcentaje Provision, WWI Provision ID""",
        day_keys(Fecha_Provision_Key="Fecha Provision"))


def risk_report(g: Star) -> DataFrame:
    zero = money(F.lit(0))
    rows = g.fresh("CIRBE_Staging", "WWI CIRBE ID")
    rows = g.key(rows, CUSTOMER, ("Cliente ID", "WWI Cliente ID"), {"Cliente Key": "Cliente Key"})
    rows = g.key(rows, INSTITUTION, ("Entidad Financiera", "Nombre Entidad"),
                 {"Entidad Financiera Key": "Entidad Financiera Key"}, versioned=False)
    rows = g.key(rows, RISK_CLASS, ("Clasificacion Riesgo", "Nombre Clasificacion"),
                 {"Clasificacion Riesgo Key": "Clasificacion Riesgo Key"}, versioned=False)
    return fact_rows(rows, """= Fecha Declaracion Key, Cliente Key, Entidad Financiera Key, Clasificacion Riesgo Key,
        Periodo Declaracion, Tipo Operacion, Naturaleza Operacion, Importe Operacion, Saldo Vivo, Tipo Garantia,
        Es Operacion Dudosa, = Riesgo Directo, = Riesgo Indirecto, = Provision Dotada, WWI CIRBE ID""", {
        **day_keys(Fecha_Declaracion_Key="Fecha Declaracion"), "Riesgo Directo": q("Importe Operacion"),
        "Riesgo Indirecto": zero, "Provision Dotada": zero,
    })


def guarantee(g: Star) -> DataFrame:
    rows = _holder(g, g.fresh("Aval_Staging", "WWI Aval ID"), "Cliente Titular Key")
    rows = g.key(rows, CUSTOMER, ("Cliente Avalista ID", "WWI Cliente ID"), {"Cliente Avalista Key": "Cliente Key"})
    return fact_rows(rows, """= Fecha Constitucion Key, = Fecha Vencimiento Key, Cliente Titular Key, Cliente Avalista Key,
        Numero Contrato, Numero Aval, Tipo Aval, Importe Avalado, Porcentaje Cobertura, Estado Aval, WWI Aval ID""",
        day_keys(Fecha_Constitucion_Key="Fecha Constitucion", Fecha_Vencimiento_Key="Fecha Vencimiento"))


FACTS = {
    f.target: f
    for f in (
        FactLoad("Fact.Credito", "Credito Key", credit, "WWI Credito ID", ranges=CREDITS, needs=(CUSTOMER, PRODUCT)),
        FactLoad("Fact.CuotaPrestamo", "Cuota Prestamo Key", instalment, "WWI Cuota ID", needs=(CUSTOMER,)),
        FactLoad("Fact.Transferencia", "Transferencia Key", transfer, "WWI Transferencia ID", ranges=TRANSFERS,
                 needs=(ACCOUNT,)),
        FactLoad("Fact.Movimiento", "Movimiento Key", movement, "WWI Movimiento ID", needs=(ACCOUNT,)),
        FactLoad("Fact.SaldoCuenta", "Saldo Cuenta Key", account_balance, "Fecha Key", by="day",
                 order=("Numero Cuenta", "Fecha"), needs=(ACCOUNT,)),
        FactLoad("Fact.Provision", "Provision Key", provision, "WWI Provision ID", needs=(CUSTOMER, RISK_CLASS)),
        FactLoad("Fact.CIRBE", "CIRBE Key", risk_report, "WWI CIRBE ID", needs=(CUSTOMER, INSTITUTION, RISK_CLASS)),
        FactLoad("Fact.Aval", "Aval Key", guarantee, "WWI Aval ID", needs=(CUSTOMER,)),
    )
}
