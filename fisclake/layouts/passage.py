"""Passenger tickets: BP-e and the air ticket BP-e TA."""

from __future__ import annotations

from fisclake.layouts.shared import (
    CONNECTION,
    CONNECTION_NAMES,
    PLACE,
    PLACE_ABROAD,
    REDUCED,
    TECHNICAL_CONTACT,
    consumption_tax,
    protocol,
)
from fisclake.layouts.tree import document, group, many

CONTACT_PLACE = f"{PLACE_ABROAD} email fone"

BPE = document(
    group(
        "BPe",
        "",
        group(
            "infBPe",
            "_Id _versao",
            group("agencia", "CNPJ xNome", group("enderAgencia", CONTACT_PLACE)),
            group("autXML", "CNPJ"),
            group("comp", "CPF IE xNome", group("enderComp", CONTACT_PLACE)),
            group("emit", "CNAE CNPJ CRT IE IEST IM TAR xFant xNome", group("enderEmit", f"{PLACE} email fone")),
            group(
                "ide",
                "UFFim UFIni cBP cDV cMunFim cMunIni cUF dhCont dhEmi indPres mod modal nBP serie tpAmb tpBPe tpEmis verProc xJust",
            ),
            group(
                "imp",
                "infAdFisco vTotTrib vTotDFe",
                group(
                    "ICMS",
                    "",
                    group("ICMSSN", "CST indSN"),
                    group("ICMS00", "CST pICMS vBC vICMS"),
                    group("ICMS20", "CST pICMS pRedBC vBC vICMS"),
                    group("ICMS45", "CST"),
                ),
                consumption_tax(REDUCED, total_prefix="ibscbs"),
            ),
            group("infAdic", "infAdFisco infCpl"),
            group("infBPeSub", "chBPe tpSub"),
            group(
                "infPassagem",
                "cLocDest cLocOrig dhEmb dhValidade xLocDest xLocOrig",
                group("infPassageiro", "CPF dNasc email fone nDoc tpDoc xDoc xNome"),
            ),
            group("infRespTec", TECHNICAL_CONTACT),
            group(
                "infValorBPe",
                "cDesconto tpDesconto vBP vDesconto vPgto vTroco xDesconto",
                many("Comp", "tpComp vComp"),
            ),
            group(
                "infViagem",
                "cPercurso dhViagem plataforma poltrona prefixo tpAcomodacao tpServ tpTrecho tpViagem xPercurso",
                group("infTravessia", "sitVeiculo tpVeiculo"),
            ),
            many(
                "pag",
                "tPag vPag xPag",
                group("card", "CNPJ cAut nParcelas nsuHost nsuTrans tBand tpIntegra xBand"),
            ),
        ),
        group("infBPeSupl", "boardPassBPe qrCodBPe"),
    ),
    protocol("protBPe", "chBPe"),
    leaves=CONNECTION,
    names=CONNECTION_NAMES,
)

BPE_AIR = document(
    group(
        "BPeTA",
        "",
        group(
            "infBPe",
            "_Id _versao",
            group("emit", "CNPJ CRT IE xFant xNome", group("enderEmit", "UF cMun nro xBairro xCpl xLgr xMun")),
            group(
                "ide",
                "UFFim UFIni cBP cDV cMunFim cMunIni cUF dhEmi indPres mod modal nBP nroBPIATA serie tpAmb tpBPe tpCompra tpEmis "
                "verProc",
            ),
            group("imp", "vTotDFe", consumption_tax({}, total_prefix="ibscbs")),
            group("infAdic", "infCpl"),
            group("infPassagem", "dhEmb dhValidade", group("infPassageiro", "nDoc tpDoc xDoc xNome")),
            group("infRespTec", TECHNICAL_CONTACT),
            group("infValorBPe", "vBP vDesconto vPgto vTroco", many("Comp", "tpComp vComp")),
            many(
                "infViagem",
                "SiglaCiaOperVoo cAeroDest cAeroOrig dhConexao dhViagem nroVoo tpAcomodacao tpServ tpTrecho tpViagem",
                column="infviagem",
            ),
            many("pag", "tPag vPag", group("card", "tpIntegra"), column="pag"),
        ),
        group("infBPeSupl", "qrCodBPe"),
    ),
    protocol("protBPe", "chBPe"),
    leaves=CONNECTION,
    names=CONNECTION_NAMES,
)
