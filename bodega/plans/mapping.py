"""Hand-kept facts of the lineage mapping: main sources, secondary sources, gaps and invalid samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Main raw table of each staging table, by raw schema.
MAIN_SOURCES = {
    "Cliente": {
        "Cliente": "Personas", "PerfilRiesgo": "ScoreCrediticio", "DireccionCliente": "DireccionesFiscales",
        "DocumentoIdentidad": "DocumentosIdentidad", "SegmentacionCliente": "SegmentacionComercial",
    },
    "Producto": {
        "Producto": "CatalogoProductos", "Comision": "TarifasComisiones", "CondicionesProducto": "CondicionesComerciales",
        "TarifaVigente": "TarifasComisiones",
    },
    "Cuenta": {
        "Cuenta": "CuentasCorrientes", "Movimiento": "MovimientosCuenta", "SaldoDiario": "MovimientosCuenta",
        "TitularidadCuenta": "TitularesCuenta",
    },
    "Credito": {
        "Credito": "Prestamos", "Cuota": "CuotasPrestamo", "Amortizacion": "AmortizacionesPagadas", "Garantia": "Garantias",
        "Aval": "Avales", "PosicionCredito": "Prestamos",
    },
    "Transferencia": {
        "Transferencia": "TransferenciasInternas", "TransferenciaAgregada": "TransferenciasInternas",
        "ComisionTransferencia": "TransferenciasExternas",
    },
    "Riesgo": {
        "CIRBE": "OperacionesCIRBE", "Provision": "ProvisionesContables", "ClasificacionRiesgo": "ClasificacionesRiesgo",
        "RiesgoConsolidado": "DeclaracionesCIRBE", "ExposicionTotal": "DeclaracionesCIRBE", "EntidadFinanciera": "EntidadesFinancieras",
    },
    "Organizacion": {"Centro": "Sucursales", "Empleado": "Empleados", "JerarquiaOrganizativa": "Sucursales"},
    "Application": {
        "City": "Cities", "Employee": "People", "PaymentMethod": "PaymentMethods", "TransactionType": "TransactionTypes",
    },
    "Sales": {"Customer": "Customers", "Order": "Orders", "Sale": "Invoices", "Transaction": "CustomerTransactions"},
    "Warehouse": {"StockItem": "StockItems", "Movement": "StockItemTransactions", "StockHolding": "StockItemHoldings"},
    "Purchasing": {"Supplier": "Suppliers", "Purchase": "PurchaseOrders"},
}

# Fields left unmapped on purpose, to be found by the checks.
CLEAN_GAPS = {
    "Cliente_Staging": ["Subsegmento", "Clasificacion Comercial"],
    "Producto_Staging": ["Edad Minima", "Edad Maxima", "Plazo Minimo Dias", "Plazo Maximo Dias"],
    "Movimiento_Staging": ["Sucursal Operacion"],
    "StockItem_Staging": ["Barcode", "Photo", "Typical Weight Per Unit"],
}
STAR_GAPS = {
    "Cliente": ["CNAE", "Subsegmento"],
    "Sale": ["Total Dry Items", "Total Chiller Items"],
    "Stock Item": ["Barcode", "Photo"],
    "Credito": ["Intereses Devengados", "Provision Dotada"],
}


def main_sources(spark: SparkSession, database: str) -> DataFrame:
    rows = [(f"{s}_Staging", database, schema, t) for schema, tables in MAIN_SOURCES.items() for s, t in tables.items()]
    return spark.createDataFrame(rows, "staging string, database string, schema string, table string")


# Raw tables that add to a staging table already mapped
# (schema, table, field, label, transformation, staging table, field, type, order).
_SECONDARY = (
    ("Cliente", "PersonasJuridicas", "CIF", "NIF empresa en terminal", "UNION con Personas: combina físicas y jurídicas", "Cliente_Staging", "Numero Documento", "nvarchar(20)", 4),
    ("Cliente", "PersonasJuridicas", "RazonSocial", "Razón social en terminal", "UNION con Personas", "Cliente_Staging", "Nombre Completo", "nvarchar(300)", 5),
    ("Cliente", "PersonasJuridicas", "CNAE", "Código CNAE actividad", "Copia directa para jurídicas", "Cliente_Staging", "CNAE", "nvarchar(10)", 11),
    ("Cuenta", "CuentasAhorro", "NumeroCuenta", "IBAN cuenta ahorro", "UNION con Corrientes y Nomina (offset ID)", "Cuenta_Staging", "Numero Cuenta", "nvarchar(24)", 3),
    ("Cuenta", "CuentasNomina", "NumeroCuenta", "IBAN cuenta nómina", "UNION con Corrientes y Ahorro (offset ID)", "Cuenta_Staging", "Numero Cuenta", "nvarchar(24)", 3),
    ("Credito", "PrestamosHipotecarios", "NumeroContrato", "Nº contrato hipoteca", "UNION con Prestamos (offset ID)", "Credito_Staging", "Numero Contrato", "nvarchar(50)", 3),
    ("Credito", "PrestamosHipotecarios", "LTVPorcentaje", "% LTV hipoteca", "Copia directa para hipotecas", "Credito_Staging", "LTV Porcentaje", "decimal", 20),
    ("Transferencia", "TransferenciasExternas", "IBANDestino", "IBAN destino externa", "UNION con Internas y SEPA (offset ID)", "Transferencia_Staging", "Cuenta Destino", "nvarchar(34)", 6),
    ("Transferencia", "TransferenciasSEPA", "BICDestino", "BIC destino SEPA", "UNION con Internas y Externas", "Transferencia_Staging", "Cuenta Destino", "nvarchar(34)", 6),
    ("Sales", "InvoiceLines", "Quantity", "Cantidad facturada", "JOIN Invoices + InvoiceLines", "Sale_Staging", "Quantity", "int", 12),
    ("Sales", "InvoiceLines", "UnitPrice", "Precio unitario", "JOIN Invoices + InvoiceLines", "Sale_Staging", "Unit Price", "decimal", 13),
    ("Sales", "OrderLines", "Quantity", "Cantidad pedida", "JOIN Orders + OrderLines", "Order_Staging", "Quantity", "int", 13),
)

# Mappings to fields that do not exist, which the diagnostics must report
# (from the raw layer?, schema, table, field, label, transformation, target schema, table, field, type, order).
_INVALID = (
    (False, "Integration", "Cliente_Staging", "Indicador VIP", "Marca cliente preferente", "Campo heredado versión anterior, pendiente revisión", "Dimension", "Cliente", "Es Cliente VIP", "bit", 99),
    (False, "Integration", "Cuenta_Staging", "Codigo Oficina Antigua", "Código oficina legado", "Mapeo manual no actualizado tras migración", "Dimension", "Cuenta", "Oficina Legacy", "varchar(20)", 98),
    (False, "Integration", "Credito_Staging", "Scoring Externo", "Puntuación buró externo", "Campo previsto no implementado en carga", "Fact", "Credito", "Score Buro Externo", "int", 97),
    (True, "Sales", "Customers", "Loyalty Points", "Puntos fidelización", "Campo planificado fase 2, no en origen", "Dimension", "Customer", "Loyalty Points", "int", 96),
)


def secondary_rows(raw: str, warehouse: str) -> list[tuple]:
    return [(raw, *row[:5], warehouse, "Integration", *row[5:]) for row in _SECONDARY]


def invalid_rows(raw: str, warehouse: str) -> list[tuple]:
    return [(raw if from_raw else warehouse, *row[:5], warehouse, *row[5:]) for from_raw, *row in _INVALID]
