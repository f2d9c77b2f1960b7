"""Declared schema of the 21 business tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names, order and types of the relational schema. Kinds:
#   int, short, flag  integers           key    15-digit account and document numbers
#   text, char        strings, `char` is blank padded      ts  wall-clock timestamp
#   p.s               decimal(p, s)      float  double
TABLE_COLUMNS: dict[str, str] = {
    "CondPAGO": "Codigo int, Descrp char, DiasCR int, Cuotas int, CodAlt text",
    "TiposCli": "Codigo text, Descrp text, IdListaPrecio text",
    "Categorias": "Categoria text, Descripcion text",
    "ClientesAtrLis": "AtrNro int, AtrCod text, AtrDes text",
    "CteVtas": "Codigo text, Descrp char, DebHab char",
    "CptTes": "Codigo char, Descrp char, DebHab char",
    "Productos": """idProducto text, Descripcion text, Abreviatura text, Litros 10.2,
        Unidad text, Orden int, cantidad_x_bulto int""",
    "Rutas": "Codigo text, Descrp char, Vnddor int, DiaRep char, Frecuencia int, Orden int",
    "repartos": "Codigo int, Descrp char, PctCom 10.2, CodSup int, NroCta key, Sucursal text",
    "Clientes": """NroCta key, Nombre text, Direcc text, Idlocalidad int, Locali text, NomPai char,
        NroSub 10.0, Categoria text, Telefn text, EMails text, CndIva char, NrCUIT char,
        ZonaVT char, CndPag int, IdListaPrecio text, TipCli text, Requiere_Comprobante int,
        Sucursal_Comprobante text, Periodo_Facturacion char, Certificado_Recepcion int,
        Tipo_Factura int, Tipo_Cobranza int, Cobrador int, FecAlt ts, FecMod ts,
        NombreFiscal text, DomicilioFiscal text, LocalidadFiscal text, CodAlt text,
        Transf_Status text, IdProvincia 10.0, suma_fiado_reparto int, InscIB char,
        Porc_IIBB 10.2, Pcia_IIBB int, Situacion_IIBB text, Nro_IIBB text, Latitud text,
        Longitud text, Usuario text, TeMovil text, IdImpuestoMunicipal int,
        BaseCalculoImpuestoMunicipal text, TasaImpuestoMunicipal 10.2, fecha_nacimiento ts,
        Usuario_mod text, GENERA_FACTURA_ELECTRONICA int, saldo 18.2, Atrib0 text, Atrib1 text,
        Atrib2 text, Atrib3 text, Atrib4 text, Atrib5 text, Atrib6 text, Atrib7 text,
        Atrib8 text, Atrib9 text, Latitud2 float, Longitud2 float, RG5329MotivoExencion text,
        RG5329PorcentajeExencion 10.2, RG5329ExencionDesde ts, RG5329ExencionHasta ts""",
    "ClientesBaja": """IdClienteBaja key, NroCta key, Nombre text, Direcc text, Locali text,
        NomPai char, Telefn char, EMails text, CndIva char, NrCUIT char, ZonaVT char,
        CndPag int, IdListaPrecio text, TipCli char, Categoria text, NroSub 10.0, IdMotivo text,
        CdRuta text, Orden int, FecAlt ts, FecBaj ts, Usuario text, Requiere_Comprobante int,
        Sucursal_Comprobante text, Periodo_Facturacion char, Certificado_Recepcion int,
        Tipo_Factura int, Tipo_Cobranza int, NombreFiscal text, DomicilioFiscal text,
        LocalidadFiscal text, CodAlt text, IdProvincia 10.0, InscIB char, Porc_IIBB 10.2,
        Situacion_IIBB text, Nro_IIBB text, Pcia_IIBB int, TeMovil text,
        IdImpuestoMunicipal int, BaseCalculoImpuestoMunicipal text, TasaImpuestoMunicipal 10.2,
        IDLOCALIDAD int, FECHA_NACIMIENTO ts, GENERA_FACTURA_ELECTRONICA int, Atrib0 text,
        Atrib1 text, Atrib2 text, Atrib3 text, Atrib4 text, Atrib5 text, Atrib6 text,
        Atrib7 text, Atrib8 text, Atrib9 text""",
    "ClientesRutas": "CdRuta text, OrdRut int, Tipo char, Cliente_Ruteo key, Estado flag",
    "Clientes_Ctas_Madres_e_Hijas": "IdCliente key, Cta_Madre key",
    "ClientesServicios": """IdCliente key, IdServicio int, NrItem int, IdEquipo key, Marca text,
        Modelo text, Nro_Serie text, Porcentaje_Descuento 5.2, Contrato text,
        NroOrdenAlta text, NroOrdenBaja text, Fecha_Desde ts, Fecha_Hasta ts, Fecha_Alta ts,
        Fecha_Modificacion ts, Fecha_Baja ts, IdProducto text, Sector text""",
    "Movimientos_Equipos": """IdMovimiento key, Fecha ts, IdReparto int, IdCliente key,
        IdClienteNuevo int, Nro_Serie text, IdProducto text, Tipo_Movimiento char, Anulado short,
        Equipo_Asignado key, IdRecambio key, Usuario text""",
    "Pedidos": """idPedido key, idVendedor int, Fecha_Pedido ts, idCliente key, Factura char,
        Nro_Comprobante text, CodForExp text, NroForExp int, Status text, IDCLIENTENUEVO key""",
    "Pedidos_Productos": """idPedido key, idProducto text, Tipo char, Cantidad 10.2, Precio 15.2,
        TIPOBONIFICACION text""",
    "Movimientos_Caja": """IdMovimiento int, IdReparto int, IdPedido key, IdCliente key, Fecha ts,
        Descripcion text, Importe 18.2, IDCLIENTENUEVO key, Nro_Recibo text, IdMotivo int,
        id_pago text, id_gateway_pago int""",
    "Movimientos_Caja_Ajustes": """idAjuste key, idReparto int, idCliente key, Fecha ts,
        Descripcion text, Importe 18.2, Usuario text, codmov text, nromov key, IDTIPOAJUSTE int,
        IdAjuste_Nuevo key, idfactura key""",
    "CtaCteVT": """CodMov text, NroMov key, NrItem int, CteOri text, FchMov ts, NroCta text,
        NroSub text, CodApl text, NroApl key, FchVnc ts, Import 18.2, Refern char,
        idfactura key""",
    "MovTes": """CodMov text, NroMov key, NrItem int, FchMov ts, TipCta char, NroCta text,
        Refern char, CodCpt char, NroBco char, Sucurs text, CPBcos int, Cheque char,
        Cuenta char, Titular char, FchVnc ts, CtaCte char, Import 18.2, DebHab char,
        CodAsi char, NroAsi key""",
}

# The date column each growing table is laid out by.
DATE_COLUMN = {
    "Movimientos_Equipos": "Fecha",
    "Pedidos": "Fecha_Pedido",
    "Movimientos_Caja": "Fecha",
    "Movimientos_Caja_Ajustes": "Fecha",
    "CtaCteVT": "FchMov",
    "MovTes": "FchMov",
}

_CANONICAL = {
    "int": T.IntegerType(),
    "flag": T.IntegerType(),
    "short": T.ShortType(),
    "key": T.LongType(),
    "text": T.StringType(),
    "char": T.StringType(),
    "ts": T.TimestampNTZType(),
    "float": T.DoubleType(),
}

# Whole numbers may be written `12.0`, which an integer reader rejects; a decimal one does not.
_AS_WRITTEN = {
    "int": T.DecimalType(11, 1),
    "flag": T.DecimalType(2, 1),
    "short": T.DecimalType(6, 1),
    "key": T.DecimalType(16, 1),
}

WHOLE_KINDS = frozenset(_AS_WRITTEN)


def columns_of(table: str) -> list[tuple[str, str]]:
    """(name, kind) pairs of a table, in file order."""
    return [tuple(part.split()) for part in TABLE_COLUMNS[table].split(",")]


def _typed(kind: str, special: dict[str, T.DataType]) -> T.DataType:
    if kind in special:
        return special[kind]
    if kind in _CANONICAL:
        return _CANONICAL[kind]
    precision, scale = kind.split(".")
    return T.DecimalType(int(precision), int(scale))


def canonical_schema(table: str) -> T.StructType:
    """Types the reports work on."""
    return T.StructType([T.StructField(n, _typed(k, {})) for n, k in columns_of(table)])


def file_schema(table: str) -> T.StructType:
    """Types used to parse the CSV text."""
    return T.StructType([T.StructField(n, _typed(k, _AS_WRITTEN)) for n, k in columns_of(table)])
