"""Hand-written tables: one small delivery business with the cases the reports must tell apart."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from rivulet.sources.tables import Tables


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def dec(value) -> Decimal:
    return Decimal(str(value))


CATALOGS = {
    "CondPAGO": [
        {"Codigo": 1, "Descrp": "CONTADO"},
        {"Codigo": 2, "Descrp": "CTA CTE 30"},
        {"Codigo": 3, "Descrp": "CTA CTE 60"},
        {"Codigo": 4, "Descrp": "CTA CTE 90"},
    ],
    "TiposCli": [{"Codigo": "HOG", "Descrp": "Hogar"}, {"Codigo": "GAS", "Descrp": "Gastronomia"}],
    "Categorias": [
        {"Categoria": "CAT-A", "Descripcion": "Premium"},
        {"Categoria": "CAT-B", "Descripcion": "Standard"},
        {"Categoria": "CAT-C", "Descripcion": "Basic"},
        {"Categoria": "CAT-D", "Descripcion": "Migrated"},
    ],
    "ClientesAtrLis": [
        {"AtrNro": 5, "AtrCod": "S1", "AtrDes": "Casa"},
        {"AtrNro": 5, "AtrCod": "S2", "AtrDes": "Restaurante"},
        {"AtrNro": 4, "AtrCod": "S2", "AtrDes": "Otro atributo"},
    ],
    "CptTes": [
        {"Codigo": "EFE", "Descrp": "Efectivo"},
        {"Codigo": "TRF", "Descrp": "Transferencia"},
        {"Codigo": "CCB", "Descrp": "Interna"},
    ],
    "Productos": [
        {"idProducto": "E", "Abreviatura": "20L", "Litros": dec(20), "Unidad": "agua"},
        {"idProducto": "EM", "Abreviatura": "12L", "Litros": dec(12), "Unidad": "agua"},
        {"idProducto": "m", "Abreviatura": "SODA", "Litros": dec("1.5"), "Unidad": "soda", "cantidad_x_bulto": 12},
        {"idProducto": "AC", "Abreviatura": "DISP", "Litros": dec(0), "Unidad": "servicio"},
    ],
    "Rutas": [
        {"Codigo": "R0001", "Vnddor": 1},
        {"Codigo": "R0002", "Vnddor": 2},
        {"Codigo": "R0155", "Vnddor": 155},
        {"Codigo": "R0157", "Vnddor": 157},
        {"Codigo": "R0146", "Vnddor": 146},
    ],
    "repartos": [
        {"Codigo": 1, "Descrp": "Uno", "CodSup": 201},
        {"Codigo": 2, "Descrp": "Dos", "CodSup": 201},
        {"Codigo": 155, "Descrp": "Gastro", "CodSup": 205},
        {"Codigo": 201, "Descrp": "Norte", "CodSup": 201},
        {"Codigo": 205, "Descrp": "Gastro jefe", "CodSup": 205},
    ],
}


def customer(key: int, since: str = "2020-01-01", **extra) -> dict:
    row = {
        "NroCta": key,
        "Nombre": f"C{key}",
        "Direcc": f"CALLE {key}",
        "Telefn": f"T{key}",
        "Categoria": "CAT-A",
        "TipCli": "HOG",
        "CndPag": 1,
        "FecAlt": ts(since),
        "Atrib5": "S1",
    }
    return {**row, **extra}


def closed(key: int, record: int, on: str | None, route: str = "R0001", since: str = "2020-01-01", **extra) -> dict:
    return {
        **customer(key, since, **extra),
        "IdClienteBaja": record,
        "FecBaj": ts(on) if on else None,
        "CdRuta": route,
        "Nombre": f"B{record}",
    }


def stop(key: int, route: str, order: int = 1) -> dict:
    return {"Cliente_Ruteo": key, "CdRuta": route, "OrdRut": order, "Estado": 1}


def order(key: int, who: int, when: str, vendor: int = 1) -> dict:
    return {"idPedido": key, "idCliente": who, "Fecha_Pedido": ts(when), "idVendedor": vendor, "Status": "PR"}


def line(key: int, product: str, quantity, price) -> dict:
    return {
        "idPedido": key,
        "idProducto": product,
        "Tipo": "N",
        "Cantidad": dec(quantity),
        "Precio": dec(price),
        "TIPOBONIFICACION": "0",
    }


def machine(who: int, serial: str, start: str, end: str | None = None) -> dict:
    return {
        "IdCliente": who,
        "IdServicio": 1,
        "NrItem": 1,
        "Nro_Serie": serial,
        "Fecha_Desde": ts(start),
        "Fecha_Baja": ts(end) if end else None,
        "IdProducto": "AC",
    }


def move(key: int, who: int, when: str | None, route: int | None, **extra) -> dict:
    row = {
        "IdMovimiento": key,
        "IdCliente": who,
        "Fecha": ts(when) if when else None,
        "IdReparto": route,
        "IdProducto": "AC",
        "Tipo_Movimiento": "R",
    }
    return {**row, **extra}


def cash(who: int, when: str, amount) -> dict:
    return {"IdMovimiento": 1, "IdCliente": who, "Fecha": ts(when), "Importe": dec(amount)}


def adjustment(who: int, when: str, amount) -> dict:
    return {"idAjuste": 1, "idCliente": who, "Fecha": ts(when), "Importe": dec(amount)}


def credit(who: str, when: str, amount, doc: str = "FACA", number: int = 1, applies: int | None = None) -> dict:
    return {
        "CodMov": doc,
        "NroMov": number,
        "NrItem": 1,
        "FchMov": ts(when),
        "NroCta": who,
        "Import": dec(amount),
        "CodApl": "FACA" if applies else None,
        "NroApl": applies,
    }


def receipt(who: str | None, when: str, method: str | None, amount, text: str | None = None, side: str = "D") -> dict:
    return {
        "CodMov": "RC",
        "NroMov": 1,
        "NrItem": 1,
        "FchMov": ts(when),
        "NroCta": who,
        "CodCpt": method,
        "Import": dec(amount),
        "Refern": text,
        "DebHab": side,
    }


def tables(spark, **rows: list[dict]) -> Tables:
    return Tables.from_rows(spark, {**CATALOGS, **rows})


def acquisitions_world(spark) -> Tables:
    return tables(
        spark,
        Clientes=[
            customer(0, "2026-03-01"),
            customer(1, "2026-02-01"),
            customer(2, "2026-03-10", Categoria="CAT-C", TipCli="GAS", CndPag=2, Atrib5="S2"),
            customer(3, "2026-03-05", Categoria="CAT-D", Direcc="av. central 1234 dpto"),
            customer(4, "2026-03-20", Categoria="CAT-B"),
            customer(5, "2026-03-20"),
            customer(6, "2026-04-02", Categoria="CAT-C", Atrib5=None),
            customer(7, "2025-01-01"),
        ],
        ClientesBaja=[
            closed(1, 11, "2026-04-30", since="2026-02-15"),
            closed(8, 81, "2026-03-31", since="2026-03-01", Categoria="CAT-B"),
            closed(8, 82, "2026-04-15", since="2026-03-01", Categoria="CAT-B"),
        ],
        ClientesRutas=[
            stop(0, "R0001"), stop(1, "R0001"), stop(2, "R0155", 2), stop(2, "R0002", 1), stop(3, "R0001"),
            stop(5, "R0146"), stop(6, "R0001"), stop(7, "R0001"),
        ],
        Pedidos=[
            order(10, 1, "2026-02-03"), order(11, 1, "2026-03-01"), order(12, 1, "2026-03-15"),
            order(20, 2, "2026-03-11", 155), order(21, 2, "2026-03-12", 155), order(22, 2, "2026-04-05 18:30", 155),
            order(23, 2, "2026-04-30 18:00", 155), order(80, 8, "2026-03-20"), order(90, 9, "2026-03-20"),
        ],
        Pedidos_Productos=[
            line(10, "E", 1, 0), line(10, "E", 1, 100), line(11, "AC", 1, 900), line(12, "E", 2, 100),
            line(20, "AC", 1, 500), line(21, "E", 1, 0), line(22, "m", 24, 10), line(23, "EM", 3, 50),
            line(80, "E", 1, 100), line(90, "ZZ", 1, 100),
        ],
    )
