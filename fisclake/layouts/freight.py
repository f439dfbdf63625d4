"""Transport documents: CT-e, CT-e OS, simplified CT-e, GTV-e and the manifest MDF-e."""

from __future__ import annotations

from fisclake.layouts.shared import (
    AUTHORISED,
    CONNECTION,
    CONNECTION_NAMES,
    GOVERNMENT_PURCHASE_TAX,
    PLACE,
    PLACE_ABROAD,
    REDUCED,
    REGULAR_TAX,
    RETURNED,
    TECHNICAL_CONTACT,
    TECHNICAL_CONTACT_SIGNED,
    consumption_tax,
    observations,
    protocol,
)
from fisclake.layouts.tree import Group, document, group, many

OTHER_STATE = "pICMSOutraUF pRedBCOutraUF vBCOutraUF vICMSOutraUF"
DESTINATION_STATE = "pFCPUFFim pICMSInter pICMSUFFim vBCUFFim vFCPUFFim vICMSUFFim vICMSUFIni"
FEDERAL_TAXES = "vCOFINS vCSLL vINSS vIR vPIS"
INVOICE = "nFat vDesc vLiq vOrig"
ENTRY = "CFOP UFEnv UFFim UFIni cCT cDV cMunEnv cMunFim cMunIni cUF"
ISSUE = "dhEmi mod modal nCT natOp procEmi serie tpAmb tpCTe tpEmis tpImp tpServ verProc xMunEnv xMunFim xMunIni"


def icms(groups: dict[str, str], prefixes: dict[str, str] | None = None) -> Group:
    """State tax: one group per taxation code."""
    prefixes = prefixes or {}
    return group("ICMS", "", *(group(name, leaves, prefix=prefixes.get(name)) for name, leaves in groups.items()))


def issuer(prefix: str | None = None) -> Group:
    return group("emit", "CNPJ CRT IE xFant xNome", group("enderEmit", f"{PLACE} fone", prefix=prefix))


# --- CT-e -------------------------------------------------------------------------------------------------------

CARGO_UNIT = group("infUnidCarga", "idUnidCarga qtdRat tpUnidCarga", group("lacUnidCarga", "nLacre"))
CARGO_UNIT_SEALS = group("infUnidCarga", "idUnidCarga qtdRat tpUnidCarga", many("lacUnidCarga", "nLacre"))
TRANSPORT_UNIT = "idUnidTransp qtdRat tpUnidTransp"

CTE_DOCUMENTS = group(
    "infDoc",
    "",
    many(
        "infNF",
        "PIN dEmi dPrev mod nCFOP nDoc nPed nPeso nRoma serie vBC vBCST vICMS vNF vProd vST",
        group("infUnidTransp", TRANSPORT_UNIT),
    ),
    many("infDCe", "chave", flat=True),
    many(
        "infNFe",
        "PIN chave dPrev",
        CARGO_UNIT_SEALS,
        many("infUnidTransp", TRANSPORT_UNIT, CARGO_UNIT, many("lacUnidTransp", "nLacre")),
    ),
    many(
        "infOutros",
        "dEmi dPrev descOutros nDoc tpDoc vDocFisc",
        CARGO_UNIT,
        group("infUnidTransp", TRANSPORT_UNIT, CARGO_UNIT, group("lacUnidTransp", "nLacre")),
    ),
)

CTE_MODES = group(
    "infModal",
    "_versaoModal",
    group(
        "aereo",
        "dPrevAereo nMinu nOCA",
        group("natCarga", "cInfManu[] xDime", prefix="aereo"),
        many("peri", "nONU qTotEmb", group("infTotAP", "qTotProd uniAP", types={"qTotProd": "double"})),
        group("tarifa", "CL cTar vTar", prefix="aereo"),
    ),
    group(
        "aquav",
        "direc irin nViag tpNav vAFRMM vPrest xNavio",
        many("balsa", "xBalsa"),
        group("detCont", "nCont", prefix="aquav_detcont"),
    ),
    group("duto", "dFim dIni vTar codPontoEntrada codPontoSaida tpContratacao"),
    group("ferrov", "fluxo tpTraf", group("trafMut", "ferrEmi respFat vFrete", prefix="ferrov")),
    group(
        "multimodal",
        "COTM indNegociavel",
        group("seg", "nApol nAver", group("infSeg", "CNPJ xSeg", prefix="multimodal"), prefix="multimodal"),
    ),
    group("rodo", "RNTRC", many("occ", "dEmi nOcc serie", group("emiOcc", "CNPJ IE UF cInt fone"))),
)

CTE_NORMAL = group(
    "infCTeNorm",
    "",
    group(
        "cobr",
        "",
        many("dup", "dVenc nDup vDup"),
        group(
            "fat",
            INVOICE,
            names={"nFat": "cobrnfat", "vDesc": "cobrvdesc", "vLiq": "cobrvliq", "vOrig": "cobr_vorig"},
        ),
    ),
    group(
        "docAnt",
        "",
        many(
            "emiDocAnt",
            "CPF CNPJ IE UF xNome",
            many("idDocAnt", "", many("idDocAntEle", "chCTe"), many("idDocAntPap", "dEmi nDoc serie subser tpDoc")),
        ),
    ),
    group("infCarga", "proPred vCarga vCargaAverb xOutCat", many("infQ", "cUnid qCarga tpMed")),
    group("infCteSub", "chCte refCteAnu indAlteraToma", group("tomaICMS", "refNFe")),
    CTE_DOCUMENTS,
    group("infGlobalizado", "xObs"),
    CTE_MODES,
    group("infServVinc", "", many("infCTeMultimodal", "chCTeMultimodal")),
    many("veicNovos", "cCor cMod chassi vFrete vUnit xCor", column="veicnovos"),
)

DELIVERY = group(
    "Entrega",
    "",
    group("comData", "dProg tpPer"),
    group("comHora", "hProg tpHor"),
    group("noInter", "hFim hIni tpHor"),
    group("noPeriodo", "dFim dIni tpPer"),
    group("semData", "tpPer"),
    group("semHora", "tpHor"),
)

CTE_PAYER = group(
    "toma4",
    "CNPJ CPF IE email fone toma xFant xNome",
    group("enderToma", PLACE_ABROAD, prefix="toma4"),
)

CTE_TAX = group(
    "imp",
    "vTotDFe infAdFisco vTotTrib",
    icms(
        {
            "ICMS00": "CST pICMS vBC vICMS",
            "ICMS20": "CST pICMS pRedBC vBC vICMS",
            "ICMS45": "CST cBenef vICMSDeson",
            "ICMS60": "CST cBenef pICMSSTRet vBCSTRet vCred vICMSDeson vICMSSTRet",
            "ICMS90": "CST cBenef pICMS pRedBC vBC vCred vICMS vICMSDeson",
            "ICMSOutraUF": f"CST cBenef vICMSDeson {OTHER_STATE}",
            "ICMSSN": "CST indSN",
        }
    ),
    group(
        "ICMSUFFim",
        DESTINATION_STATE,
        names={"pFCPUFFim": "icmsuffim_pfcppufim", "vFCPUFFim": "icmsuffim_vfcppufim"},
    ),
    consumption_tax(
        {**RETURNED, **REDUCED},
        leaves="CST cClassTrib indDoacao",
        within=[group("gTribRegular", REGULAR_TAX), group("gTribCompraGov", GOVERNMENT_PURCHASE_TAX)],
        plain="gCBS",
        suffixes={"gIBSUF": "ibsuf", "gIBSMun": "ibsmun"},
    ),
)

CTE = document(
    protocol("protCTe", "chCTe", version=""),
    group(
        "CTe",
        "",
        group("infCTeSupl", "qrCodCTe"),
        group(
            "infCte",
            "_Id _versao",
            AUTHORISED,
            group(
                "compl",
                "destCalc origCalc xCaracAd xCaracSer xEmi xObs",
                DELIVERY,
                *observations("ObsCont", "ObsFisco"),
                group("fluxo", "xDest xOrig xRota", many("pass", "xPass")),
            ),
            group("dest", "CNPJ CPF IE ISUF email fone xNome", group("enderDest", PLACE_ABROAD)),
            group("emit", "CNPJ CPF CRT IE IEST xFant xNome", group("enderEmit", f"{PLACE} fone")),
            group("exped", "CNPJ CPF IE email fone xNome", group("enderExped", PLACE_ABROAD)),
            group("receb", "CNPJ CPF IE email fone xNome", group("enderReceb", PLACE_ABROAD, prefix="receb")),
            group("rem", "CNPJ CPF IE email fone xFant xNome", group("enderReme", PLACE_ABROAD, prefix="rem")),
            group(
                "ide",
                f"{ENTRY} {ISSUE} dhCont indGlobalizado indIEToma retira xDetRetira xJust",
                group("toma3", "toma"),
                CTE_PAYER,
            ),
            CTE_TAX,
            CTE_NORMAL,
            group("infCteAnu", "chCte dEmi"),
            many("infCteComp", "chCTe", column="infCteComp"),
            group("infRespTec", TECHNICAL_CONTACT_SIGNED),
            group("infSolicNFF", "xSolic"),
            group("vPrest", "vRec vTPrest", many("Comp", "vComp xNome")),
        ),
    ),
    leaves=CONNECTION,
    names=CONNECTION_NAMES,
)

# --- CT-e OS ----------------------------------------------------------------------------------------------------


def joined_names(prefix: str, leaves: str, drop: str = "") -> dict[str, str]:
    """Columns that run the leaf into the group code, as in ``icms_00CST``."""
    return {leaf: prefix + (leaf[0].upper() + leaf[1:]).removesuffix(drop) for leaf in leaves.split()}


CTE_OS_ICMS = {
    "ICMS00": "CST pICMS vBC vICMS",
    "ICMS20": "CST cBenef pICMS pRedBC vBC vICMS vICMSDeson",
    "ICMS45": "CST cBenef vICMSDeson",
    "ICMS90": "CST cBenef pICMS pRedBC vBC vCred vICMS vICMSDeson",
    "ICMSOutraUF": f"CST {OTHER_STATE}",
    "ICMSSN": "CST indSN",
}

CTE_OS_TAX = group(
    "imp",
    "infAdFisco vTotTrib vTotDFe",
    group(
        "ICMS",
        "",
        *(
            group(name, leaves, names=joined_names(f"icms_{name.removeprefix('ICMS')}", leaves, drop="OutraUF"))
            for name, leaves in CTE_OS_ICMS.items()
        ),
    ),
    group("ICMSUFFim", DESTINATION_STATE, names=joined_names("icms_UFFim", DESTINATION_STATE, drop="Fim")),
    group("infTribFed", FEDERAL_TAXES, names=joined_names("infTrib_Fed", FEDERAL_TAXES)),
    consumption_tax({**RETURNED, **REDUCED}, plain="gIBSUF"),
    names={"infAdFisco": "infAdFisco", "vTotTrib": "vTotTrib"},
)

CTE_OS = document(
    group(
        "protCTe",
        "",
        group(
            "infProt",
            "_Id cStat chCTe dhRecbto digVal nProt tpAmb xMotivo verAplic",
            names={"chCTe": "chave", "cStat": "protcte_cstat"},
        ),
    ),
    group(
        "CTeOS",
        "_versao",
        group("infCTeSupl", "qrCodCTe", prefix=""),
        group(
            "infCte",
            "_Id _versao",
            many("autXML", "CNPJ CPF", column="autXML"),
            group("compl", "xCaracAd xCaracSer xEmi xObs", *observations("ObsCont", "ObsFisco")),
            group(
                "emit",
                "CNPJ CRT IE xFant xNome",
                group("enderEmit", f"{PLACE} fone"),
                names={"xFant": "enderEmit_XFant", "xNome": "enderEmit_XNome"},
            ),
            group("ide", f"{ENTRY} {ISSUE} indIEToma", many("infPercurso", "UFPer")),
            CTE_OS_TAX,
            group(
                "infCTeNorm",
                "",
                group("cobr", "", many("dup", "dVenc nDup vDup", column="cobrDup"), group("fat", INVOICE)),
                group("infCteSub", "chCte"),
                many("infDocRef", "chBPe dEmi nDoc serie subserie vDoc", column="infDocRef"),
                many("infGTVe", "chCTe", many("Comp", "tpComp vComp xComp"), column="infGTVe"),
                group(
                    "infModal",
                    "_versaoModal",
                    group(
                        "rodoOS",
                        "NroRegEstadual TAF",
                        group("infFretamento", "dhViagem tpFretamento"),
                        group(
                            "veic",
                            "RENAVAM UF placa",
                            group("prop", "CNPJ CPF IE NroRegEstadual TAF UF tpProp xNome", prefix="Veic_Prop"),
                        ),
                    ),
                    names={"_versaoModal": "infModalVersao"},
                ),
                group("infServico", "xDescServ", group("infQ", "qCarga", names={"qCarga": "infQ_oQCarga"})),
                many("seg", "nApol respSeg xSeg", column="seg"),
            ),
            group("infCteComp", "chCTe"),
            group("infRespTec", TECHNICAL_CONTACT_SIGNED),
            group("toma", "CNPJ CPF IE email fone xFant xNome", group("enderToma", PLACE_ABROAD, prefix="toma")),
            group("vPrest", "vRec vTPrest", many("Comp", "vComp xNome")),
            names={"_Id": "idCTe", "_versao": "versaoInfCte"},
        ),
        names={"_versao": "versaoCTeOS"},
    ),
    leaves=CONNECTION,
    names=CONNECTION_NAMES,
)

# --- simplified CT-e --------------------------------------------------------------------------------------------

CTE_SIMPLIFIED = document(
    group("protCTe", "", group("infProt", "_Id chCTe cStat", names={"chCTe": "chave"})),
    group(
        "CTeSimp",
        "",
        group("infCTeSupl", "qrCodCTe", prefix=""),
        group(
            "infCte",
            "_Id _versao",
            group("autXML", "CNPJ CPF"),
            group("cobr", "", group("dup", "nDup vDup"), group("fat", "nFat vOrig vLiq")),
            group("compl", "xCaracAd xObs", *observations("ObsCont"), group("fluxo", "xDest xOrig xRota", prefix=""), prefix=""),
            many(
                "det",
                "_nItem cMunFim cMunIni vPrest vRec xMunFim xMunIni",
                group("infNFe", "chNFe dPrev"),
                many("Comp", "xNome vComp"),
                column="det",
            ),
            issuer(prefix="emit"),
            group(
                "ide",
                "CFOP UFEnv UFFim UFIni cCT cDV cMunEnv cUF dhEmi mod modal nCT natOp procEmi retira serie tpAmb tpCTe tpEmis "
                "tpImp tpServ verProc xMunEnv",
            ),
            group(
                "imp",
                "vTotTrib infAdFisco",
                icms(
                    {
                        "ICMS00": "CST pICMS vBC vICMS",
                        "ICMS45": "CST",
                        "ICMS90": "CST pICMS vBC vICMS vCred",
                        "ICMSSN": "CST indSN",
                        "ICMSOutraUF": "CST pICMSOutraUF vBCOutraUF vICMSOutraUF",
                    },
                    prefixes={"ICMS00": "icms"},
                ),
                group("ICMSUFFim", DESTINATION_STATE),
                group(
                    "IBSCBS",
                    "CST cClassTrib",
                    group(
                        "gIBSCBS",
                        "vBC vIBS",
                        *(
                            group(level, f"p{tax} v{tax}", prefix="")
                            for level, tax in (("gIBSUF", "IBSUF"), ("gIBSMun", "IBSMun"), ("gCBS", "CBS"))
                        ),
                        prefix="ibscbs",
                    ),
                ),
                prefix="",
            ),
            group("infCarga", "proPred vCarga vCargaAverb xOutCat", many("infQ", "cUnid qCarga tpMed"), prefix=""),
            group("infModal", "_versaoModal", group("rodo", "RNTRC"), prefix=""),
            group("infRespTec", TECHNICAL_CONTACT, prefix="respTec"),
            group("toma", "CNPJ IE fone indIEToma toma xNome", group("enderToma", PLACE_ABROAD, prefix="toma")),
            group("total", "vTPrest vTotDFe vTRec", prefix=""),
            names={"_Id": "cte_Id", "_versao": "cte_versao"},
        ),
    ),
    leaves="_dhConexao _ipTransmissor _nPortaCon",
    names={"_dhConexao": "dhconexao", "_ipTransmissor": "_ipTransmissor", "_nPortaCon": "_nPortaCon"},
)

# --- GTV-e ------------------------------------------------------------------------------------------------------

GTVE = document(
    protocol("protCTe", "chCTe", version=""),
    group(
        "GTVe",
        "",
        group("infCTeSupl", "qrCodCTe"),
        group(
            "infCte",
            "_Id _versao",
            group("compl", "xEmi xObs"),
            group("dest", "CNPJ IE xNome", group("enderDest", PLACE_ABROAD)),
            group("destino", PLACE),
            group(
                "detGTV",
                "qCarga",
                many("infEspecie", "tpEspecie tpNumerario vEspecie xMoedaEstr"),
                group("infVeiculo", "RNTRC UF placa"),
            ),
            group("emit", "CNPJ IE xFant xNome", group("enderEmit", f"{PLACE} fone")),
            group(
                "ide",
                "CFOP UFEnv cCT cDV cMunEnv cUF dhChegadaDest dhEmi dhSaidaOrig indIEToma mod modal nCT natOp serie tpAmb tpCTe "
                "tpEmis tpImp tpServ verProc xMunEnv",
                group("toma", "toma"),
                group("tomaTerceiro", "CNPJ IE toma xNome", group("enderToma", PLACE)),
            ),
            group("infRespTec", TECHNICAL_CONTACT),
            group("origem", PLACE),
            group("rem", "CNPJ IE email fone xFant xNome", group("enderReme", PLACE_ABROAD)),
        ),
    ),
)

# --- MDF-e ------------------------------------------------------------------------------------------------------

HAZARDOUS = many("peri", "grEmb nONU qTotProd qVolTipo xClaRisco xNomeAE")
SEALS = many("lacUnidTransp", "nLacre")

MDFE_DOCUMENTS = group(
    "infDoc",
    "",
    many(
        "infMunDescarga",
        "cMunDescarga xMunDescarga",
        many("infCT", "dEmi nCT serie vCarga"),
        many(
            "infCTe",
            "SegCodBarra chCTe indReentrega",
            group("infEntregaParcial", "qtdParcial qtdTotal"),
            many("infUnidTransp", TRANSPORT_UNIT, CARGO_UNIT_SEALS, SEALS),
            HAZARDOUS,
        ),
        group("infNF", "CNPJ UF dEmi nNF serie vNF", group("infUnidTransp", "idUnidTransp tpUnidTransp", SEALS)),
        many(
            "infNFe",
            "SegCodBarra chNFe indReentrega",
            many(
                "infUnidTransp",
                TRANSPORT_UNIT,
                many("infUnidCarga", "idUnidCarga qtdRat tpUnidCarga", many("lacUnidCarga", "nLacre")),
                SEALS,
            ),
            HAZARDOUS,
        ),
    ),
)

OWNER = "CNPJ CPF IE RNTRC UF tpProp xNome"

MDFE_ROAD = group(
    "rodo",
    "CIOT RNTRC codAgPorto",
    group(
        "infANTT",
        "RNTRC",
        many("infCIOT", "CIOT CNPJ CPF"),
        many("infContratante", "CNPJ CPF idEstrangeiro xNome", group("infContrato", "NroContrato vContratoGlobal")),
        many(
            "infPag",
            "CNPJ CPF idEstrangeiro tpAntecip indAltoDesemp indAntecipaAdiant indPag vAdiant vContrato xNome",
            many("Comp", "tpComp vComp xComp"),
            group("infBanc", "CNPJIPEF PIX codAgencia codBanco"),
            many("infPrazo", "dVenc nParcela vParcela"),
        ),
        group(
            "valePed",
            "categCombVeic",
            many("disp", "CNPJForn CNPJPg CPFPg nCompra tpValePed vValePed", column="disp"),
            names={"categCombVeic": "categCombVeic"},
        ),
    ),
    many("lacRodo", "nLacre"),
    group(
        "veicPrincipal",
        "cInt capKG capM3 placa tara",
        group("condutor", "CPF xNome"),
        group("prop", "RNTRC", prefix="veicprincipal"),
    ),
    many("veicReboque", "RENAVAM UF cInt capKG capM3 placa tara tpCar", group("prop", OWNER)),
    group(
        "veicTracao",
        "RENAVAM UF cInt capKG capM3 placa tara tpCar tpRod",
        many("condutor", "CPF xNome"),
        group("prop", OWNER, names={"RNTRC": "veictracao_rntrc"}),
    ),
)

MDFE = document(
    group(
        "MDFe",
        "",
        group(
            "infMDFe",
            "_Id _versao",
            group("infSolicNFF", "xSolic"),
            AUTHORISED,
            group("emit", "CNPJ CPF IE xFant xNome", group("enderEmit", f"{PLACE} email fone")),
            group(
                "ide",
                "UFFim UFIni indCarregaPosterior cDV cMDF cUF dhEmi dhIniViagem indCanalVerde mod modal nMDF procEmi serie tpAmb "
                "tpEmis tpEmit tpTransp verProc",
                many("infMunCarrega", "cMunCarrega xMunCarrega"),
                many("infPercurso", "UFPer"),
            ),
            group("infAdic", "infAdFisco infCpl"),
            MDFE_DOCUMENTS,
            group(
                "infModal",
                "_versaoModal",
                group("aereo", "cAerDes cAerEmb dVoo matr nVoo nac"),
                group(
                    "aquav",
                    "CNPJAgeNav cEmbar cPrtDest cPrtEmb irin nViag prtTrans tpEmb tpNav xEmbar",
                    group("infTermCarreg", "cTermCarreg xTermCarreg"),
                    group("infTermDescarreg", "cTermDescarreg xTermDescarreg"),
                ),
                group(
                    "ferrov",
                    "",
                    group("trem", "qVag xDest xOri xPref"),
                    many("vag", "TU nVag pesoBC pesoR serie tpVag"),
                ),
                MDFE_ROAD,
            ),
            group("infRespTec", TECHNICAL_CONTACT_SIGNED),
            many("lacres", "nLacre"),
            group(
                "prodPred",
                "NCM cEAN tpCarga xProd",
                group(
                    "infLotacao",
                    "",
                    *(group(name, "CEP latitude longitude") for name in ("infLocalCarrega", "infLocalDescarrega")),
                ),
            ),
            many("seg", "nApol nAver[]", group("infResp", "CNPJ CPF respSeg"), group("infSeg", "CNPJ xSeg")),
            group("tot", "cUnid qCT qCTe qCarga qMDFe qNF qNFe vCarga"),
        ),
        group("infMDFeSupl", "qrCodMDFe"),
    ),
    group(
        "protMDFe",
        "_versao",
        group(
            "infProt",
            "_Id cStat chMDFe dhRecbto digVal nProt tpAmb verAplic xMotivo",
            names={
                "_Id": "protmdfe_mdfe_infprot_id",
                "cStat": "protmdfe_mdfe_infprot_cstat",
                "chMDFe": "chave",
                "dhRecbto": "protmdfe_dhrecbto",
                "digVal": "protmdfe_digval",
                "nProt": "protmdfemdfe_nprot",
                "tpAmb": "protmdfemdfe_tpamb",
                "verAplic": "protmdfemdfe_veraplic",
                "xMotivo": "protmdfemdfe_xmotivo",
            },
        ),
        names={"_versao": "protmdfe_mdfe_versao"},
    ),
    leaves=CONNECTION,
    names=CONNECTION_NAMES,
)
