"""Hand-made bronze documents (FIXTURES.md §1). Values are invented."""

from __future__ import annotations

import json
import os


def _put(root: str, rel: str, doc, pretty: bool = False) -> None:
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        if pretty:
            json.dump(doc, f, indent=4, ensure_ascii=False)
        else:
            f.write(json.dumps(doc, ensure_ascii=False) + "\n")


def phase(cur, volt, cos, react):
    return {"acCurrent": cur, "acVoltage": volt, "cosPhi": cos, "reactivePower": react}


def reading(date, dcv, temp, power, energy, l1=None, l2=None, l3=None):
    r = {"date": date, "dcVoltage": dcv, "temperature": temp, "totalActivePower": power,
         "totalEnergy": energy, "inverterMode": "MPPT"}
    for k, v in (("L1Data", l1), ("L2Data", l2), ("L3Data", l3)):
        if v is not None:
            r[k] = v
    return r


D1, D2 = "2022-12-01", "2022-12-02"


def write_inverters(root: str) -> dict:
    """Cases A-J of FIXTURES §1.1. Returns expected silver row counts per day."""
    base = os.path.join(root, "inverters_data")
    # A: three-phase, 2 readings (second listed first: out of order, case J)
    a = {"data": {"count": 2, "telemetries": [
        reading(f"{D1} 10:15:00", 700.5, 41.0, 5000, 123456.0,
                phase(12.0, 230.1, 0.99, 1.5), phase(12.5, 231.0, 0.98, 2.0),
                phase(13.0, 229.9, 0.97, -0.5)),
        reading(f"{D1} 10:00:00", 690.0, 40.0, 4800, 123000.0,
                phase(11.0, 230.0, 0.95, 1.0), phase(11.5, 230.5, 0.96, 1.0),
                phase(12.0, 231.5, 0.97, 1.0)),
        # J: exact duplicate of the previous reading
        reading(f"{D1} 10:00:00", 690.0, 40.0, 4800, 123000.0,
                phase(11.0, 230.0, 0.95, 1.0), phase(11.5, 230.5, 0.96, 1.0),
                phase(12.0, 231.5, 0.97, 1.0)),
    ]}}
    _put(base, f"dt={D1}/site_id=101/inv_id=AB12-5D/part-a.json", a)
    # B + F: single phase, numeric-looking id '73E4'
    b = {"data": {"telemetries": [
        reading(f"{D1} 11:00:00", 400.0, 35.0, 2000, 5000.0, phase(8.0, 229.0, 1.0, 0.2))]}}
    _put(base, f"dt={D1}/site_id=101/inv_id=73E4/part-b.json", b)
    # C: empty telemetries; F: id '0012'
    _put(base, f"dt={D1}/site_id=102/inv_id=0012/part-c.json", {"data": {"telemetries": []}})
    # D: data null
    _put(base, f"dt={D1}/site_id=102/inv_id=X1/part-d.json", {"data": None})
    # E: error body is a bare int
    _put(base, f"dt={D1}/site_id=103/inv_id=ERR/part-e.json", 429)
    # H: L1 cosPhi NULL, L2 present; out-of-range values for the gold rules
    h = {"data": {"telemetries": [
        reading(f"{D1} 12:00:00", 650.0, 45.0, 3000, 7000.0,
                phase(-0.5, 230.0, None, -3.0), phase(205.0, 245.0, 0.91, 0.5),
                phase(300.0, 251.0, 0.90, 0.5))]}}
    _put(base, f"dt={D1}/site_id=102/inv_id=H7/part-h.json", h)
    # G: day 2 with fractional totalActivePower (day 1 had whole numbers)
    g = {"data": {"telemetries": [
        reading(f"{D2} 09:00:00", 610.0, 30.0, 4500.25, 130000.0,
                phase(10.0, 230.0, 0.99, 1.0), phase(10.0, 230.0, 0.99, 1.0),
                phase(10.0, 230.0, 0.99, 1.0))]}}
    _put(base, f"dt={D2}/site_id=101/inv_id=AB12-5D/part-g.json", g)
    # I: whole day single-phase only (no L2Data / L3Data anywhere on this day)
    i = {"data": {"telemetries": [
        reading(f"{D2} 09:15:00", 300.0, 28.0, 1000, 2000.0, phase(5.0, 228.0, 0.95, 0.1))]}}
    _put(base, f"dt={D2}/site_id=104/inv_id=S1/part-i.json", i)
    return {D1: 5, D2: 2}


def write_inventory(root: str) -> None:
    base = os.path.join(root, "sites_invertory_details")
    _put(base, f"dt={D1}/site_id=101/inv.json", {"Inventory": {"inverters": [
        {"manufacturer": "Acme", "model": "M1", "name": "Inverter 1", "SN": "AB12-5D"},
        {"model": "M2", "name": "Inverter 2", "SN": "73E4"}]}})
    _put(base, f"dt={D1}/site_id=102/inv.json", {"Inventory": {"inverters": [
        {"manufacturer": "Acme", "model": "M1", "name": "Inverter 1", "SN": "0012"},
        {"manufacturer": "Acme", "model": "M1", "name": "Inverter 2", "SN": "X1"},
        {"manufacturer": "Acme", "model": "M1", "name": "Inverter 3", "SN": "H7"},
        {"manufacturer": "Acme", "model": "M3", "name": "Inverter 4", "SN": "H8"}]}})
    _put(base, f"dt={D1}/site_id=103/inv.json", {"Inventory": {"inverters": []}})
    _put(base, f"dt={D2}/site_id=101/inv.json", {"Inventory": {"inverters": [
        {"manufacturer": "Acme", "model": "M1", "name": "Inverter 1", "SN": "AB12-5D"}]}})


def site(i, name, address=None, address2=None, city="Town", account=5000):
    loc = {"country": "Nowhere", "city": city, "zip": "00000", "timeZone": "UTC",
           "countryCode": "NW"}
    if address is not None:
        loc["address"] = address
    if address2 is not None:
        loc["address2"] = address2
    return {"id": i, "name": name, "accountId": account, "status": "Active",
            "peakPower": 100.0 + i, "installationDate": "2022-04-26", "notes": "",
            "type": "Optimizers & Inverters", "location": loc,
            "publicSettings": {"isPublic": False}}


def write_sites(root: str, pages: bool = True) -> None:
    base = os.path.join(root, "sites_metadata")
    first = [site(i, f"Site {i}", address=f"Street {i}") for i in range(1, 101)]
    first[0] = site(1, "אתר מזרחי", address="Main", address2="Hill 2")
    first[1] = site(2, "No street", city="Village")
    second = [site(i, f"Site {i}", address=f"Street {i}") for i in range(101, 144)]
    _put(base, f"dt={D1}/page-0.json", {"sites": {"count": 143, "site": first}})
    if pages:
        _put(base, f"dt={D1}/page-1.json", {"sites": {"count": 143, "site": second}})
    _put(base, f"dt={D2}/page-0.json", {"sites": {"count": 3, "site": first[:2]}})


def write_all(root: str) -> None:
    write_inverters(root)
    write_inventory(root)
    write_sites(root)
