"""Groups that several national layouts have in common. The leaf names are fixed values of those layouts."""

from __future__ import annotations

from fisclake.layouts.tree import Group, group, many

PLACE = "CEP UF cMun nro xBairro xCpl xLgr xMun"
PLACE_ABROAD = f"{PLACE} cPais xPais"
ADDRESS = f"{PLACE_ABROAD} fone"
CONNECTION = "_dhConexao _ipTransmissor _nPortaCon _versao _xmlns"
CONNECTION_NAMES = {leaf: leaf.lstrip("_") for leaf in CONNECTION.split()}
TECHNICAL_CONTACT = "CNPJ email fone xContato"
TECHNICAL_CONTACT_SIGNED = f"{TECHNICAL_CONTACT} hashCSRT idCSRT"
AUTHORISED = many("autXML", "CNPJ CPF")


def observations(*names: str) -> list[Group]:
    return [many(name, "_xCampo xTexto") for name in names]


def protocol(root: str, key: str, leaves: str = "", prefix: str | None = None, version: str = "_versao") -> Group:
    """Authorisation answer; ``key`` is the element that carries the access key."""
    return group(
        root,
        version,
        group("infProt", f"_Id {key} cStat dhRecbto digVal nProt tpAmb verAplic xMotivo {leaves}", names={key: "chave"}),
        prefix=prefix,
    )


def rate_group(level: str, rate: str, amount: str, adjustments: dict[str, str], *, prefix: str | None = None,
               plain: bool = False, suffix: str = "") -> Group:
    """One level (state, municipality, federal) of the consumption tax with its adjustments.

    The columns of an adjustment start with the level, unless a layout names them ``plain`` or by ``suffix``.
    """
    children = []
    for name, leaves in adjustments.items():
        start = name if plain or suffix else f"{level}_{name}"
        names = {leaf: f"{start}_{leaf}_{suffix}" for leaf in leaves.split()} if suffix else None
        children.append(group(name, leaves, prefix=start, names=names))
    return group(level, f"{rate} {amount}", *children, prefix=prefix)


DEFERRED = {"gDif": "pDif vDif"}
RETURNED = {"gDevTrib": "vDevTrib"}
REDUCED = {"gRed": "pRedAliq pAliqEfet"}
REGULAR_TAX = "CSTReg cClassTribReg " + " ".join(
    f"pAliqEfetReg{tax} vTribReg{tax}" for tax in ("IBSUF", "IBSMun", "CBS")
)
GOVERNMENT_PURCHASE_TAX = " ".join(f"pAliq{tax} vTrib{tax}" for tax in ("IBSUF", "IBSMun", "CBS"))


def consumption_tax(adjustments: dict[str, str], *, leaves: str = "CST cClassTrib", within: list[Group] | None = None,
                    beside: list[Group] | None = None, total_prefix: str = "gIBSCBS", level_prefix: str = "",
                    plain: str = "", suffixes: dict[str, str] | None = None) -> Group:
    """IBS/CBS group of one document or item."""
    levels = [
        rate_group(
            level,
            f"p{tax}",
            f"v{tax}",
            adjustments,
            prefix=f"{level_prefix}{level}",
            plain=level == plain,
            suffix=(suffixes or {}).get(level, ""),
        )
        for level, tax in (("gIBSUF", "IBSUF"), ("gIBSMun", "IBSMun"), ("gCBS", "CBS"))
    ]
    detail = group("gIBSCBS", "vBC vIBS", *levels, *(within or []), prefix=total_prefix)
    return group("IBSCBS", leaves, detail, *(beside or []))


def consumption_tax_totals(*extra: Group, federal: str = "vCBS vDevTrib vDif", both: str = "vIBS", path: str = "") -> Group:
    """IBS/CBS totals; ``path`` lengthens the column names where a layout has several of them."""
    below = f"{path}gIBS_" if path else ""
    return group(
        "IBSCBSTot",
        "vBCIBSCBS",
        group("gCBS", federal, prefix=f"{path}gCBS"),
        group(
            "gIBS",
            both,
            group("gIBSMun", "vDevTrib vDif vIBSMun", prefix=f"{below}gIBSMun"),
            group("gIBSUF", "vDevTrib vDif vIBSUF", prefix=f"{below}gIBSUF"),
            prefix=f"{path}gIBS",
        ),
        *extra,
    )
