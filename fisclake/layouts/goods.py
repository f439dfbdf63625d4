"""Goods invoices: NF-e (model 55) and NFC-e (model 65), document and line items."""

from __future__ import annotations

from fisclake.layouts.shared import (
    ADDRESS,
    DEFERRED,
    GOVERNMENT_PURCHASE_TAX,
    REDUCED,
    REGULAR_TAX,
    RETURNED,
    TECHNICAL_CONTACT_SIGNED,
    consumption_tax,
    consumption_tax_totals,
    observations,
    protocol,
)
from fisclake.layouts.tree import Group, Layout, document, group, many

PARTY_PLACE = f"{ADDRESS} CNPJ CPF IE email xNome"

IDENTIFICATION = group(
    "ide",
    "dhEmi cDV indBemMovelUsado cMunFGIBS cMunFG cNF cUF dPrevEntrega dhCont dhSaiEnt finNFe tpNFDebito idDest indFinal "
    "indIntermed indPres mod nNF natOp procEmi serie tpAmb tpEmis tpImp tpNF verProc xJust",
    group("gCompraGov", "pRedutor tpEnteGov tpOperGov"),
    group("gPagAntecipado", "refNFe"),
    many(
        "NFref",
        "refCTe refNFe refNFeSig",
        group("refECF", "mod nCOO nECF"),
        group("refNF", "AAMM CNPJ cUF mod nNF serie"),
        group("refNFP", "AAMM CNPJ CPF IE cUF mod nNF serie"),
    ),
    names={"nNF": "ide_nnfe"},
)

PARTIES = [
    group("emit", "CNPJ CPF CNAE CRT IE IEST IM xFant xNome", group("enderEmit", ADDRESS)),
    group(
        "dest",
        "CNPJ CPF IE IM ISUF email xNome idEstrangeiro indIEDest",
        group("enderDest", ADDRESS),
        names={"idEstrangeiro": "idEstrangeiro", "indIEDest": "indIEDest"},
    ),
    group("retirada", PARTY_PLACE),
    group("entrega", PARTY_PLACE),
    group("avulsa", "CNPJ UF dEmi dPag fone matr nDAR repEmi vDAR xAgente xOrgao"),
]

MONOPHASE = [f"v{tax}Mono{kind}" for kind in ("", "Reten", "Ret") for tax in ("IBS", "CBS")]

TOTALS = group(
    "total",
    "vNFTot",
    group(
        "ICMSTot",
        "qBCMono qBCMonoRet qBCMonoReten vBC vBCST vCOFINS vDesc vFCP vFCPST vFCPSTRet vFCPUFDest vFrete vICMS vICMSDeson "
        "vICMSMono vICMSMonoRet vICMSMonoReten vICMSUFDest vICMSUFRemet vII vIPI vIPIDevol vNF vOutro vPIS vProd vST vSeg "
        "vTotTrib",
    ),
    group("ISTot", "vIS"),
    consumption_tax_totals(
        group("gMono", " ".join(MONOPHASE)),
        group("gEstornoCred", "vIBSEstCred vCBSEstCred"),
        federal="vDif vDevTrib vCBS vCredPres vCredPresCondSus",
        both="vIBS vCredPres vCredPresCondSus",
    ),
    group(
        "ISSQNtot",
        "cRegTrib dCompet vBC vCOFINS vDeducao vDescCond vDescIncond vISS vISSRet vOutro vPIS vServ",
    ),
    group("retTrib", "vBCIRRF vBCRetPrev vIRRF vRetCOFINS vRetCSLL vRetPIS vRetPrev"),
    names={"vNFTot": "IBSCBSTot_vNFTot"},
)

PAYMENT = [
    group(
        "cobr",
        "",
        many("dup", "dVenc nDup vDup"),
        group("fat", "nFat vDesc vLiq vOrig", prefix="cobr_fat"),
    ),
    group(
        "pag",
        "vTroco",
        many(
            "detPag",
            "CNPJPag UFPag dPag indPag tPag vPag xPag",
            group("card", "CNPJ CNPJReceb cAut idTermPag tBand tpIntegra"),
        ),
    ),
]

CARRIER_NAMES = {"xMun": "transp_transporta_xMunJ"}


def transport(leaves: str) -> Group:
    return group(
        "transp",
        leaves,
        many("reboque", "RNTC UF placa"),
        group("retTransp", "CFOP cMunFG pICMSRet vBCRet vICMSRet vServ", prefix="transp_retTransp"),
        group(
            "transporta",
            "CNPJ CPF IE UF xEnder xMun xNome",
            prefix="transp_transporta",
            names=CARRIER_NAMES,
            column="transp_transporta",
        ),
        group("veicTransp", "RNTC UF placa", prefix="transp_veicTransp"),
        many("vol", "esp marca nVol pesoB pesoL qVol", many("lacres", "nLacre")),
    )


OTHER = [
    group("compra", "xCont xNEmp xPed"),
    group("exporta", "UFSaidaPais xLocDespacho xLocExporta"),
    group("infAdic", "infAdFisco infCpl", *observations("obsCont", "obsFisco"), many("procRef", "indProc nProc tpAto")),
    group("infIntermed", "CNPJ idCadIntTran"),
    group("infRespTec", TECHNICAL_CONTACT_SIGNED),
    group("infSolicNFF", "xSolic"),
]

FARMING = group(
    "agropecuario",
    "",
    group("defensivo", "CPFRespTec nReceituario", prefix="agro_defensivo"),
    group("guiaTransito", "UFGuia nGuia serieGuia tpGuia", prefix="agro_guiatransito"),
)


def _body(*extra: Group, transport_leaves: str) -> Group:
    parts = [IDENTIFICATION, *PARTIES, TOTALS, *PAYMENT, transport(transport_leaves), *OTHER, *extra]
    return group("NFe", "", group("infNFe", "_Id _versao", *parts))


NFE = document(
    protocol("protNFe", "chNFe", "cMsg xMsg", prefix="prot"),
    _body(
        many("autXML", "CNPJ CPF", column="autxml"),
        FARMING,
        transport_leaves="modFrete vagao balsa",
    ),
    leaves="_versao _xmlns",
    names={"_versao": "versao_xml", "_xmlns": "xmlns"},
)

NFCE = document(protocol("protNFe", "chNFe", version=""), _body(transport_leaves="modFrete vagao"))

# --- line items -------------------------------------------------------------------------------------------------

ORIGIN = "orig CST"
SIMPLES = "orig CSOSN"
OWN = "modBC vBC pICMS vICMS"
SUBSTITUTION = "modBCST pMVAST pRedBCST vBCST pICMSST vICMSST"
FUND = "vBCFCP pFCP vFCP"
FUND_SUBSTITUTION = "vBCFCPST pFCPST vFCPST"
RELIEF = "vICMSDeson motDesICMS indDeduzDeson"
RELIEF_SUBSTITUTION = "vICMSSTDeson motDesICMSST"
RETAINED = "vBCSTRet pST vICMSSubstituto vICMSSTRet vBCFCPSTRet pFCPSTRet vFCPSTRet"
EFFECTIVE = "pRedBCEfet vBCEfet pICMSEfet vICMSEfet"
SIMPLES_CREDIT = "pCredSN vCredICMSSN"
PER_UNIT = "qBCMono adRemICMS vICMSMono"

# The state tax has one group per taxation code; each is a combination of the parts above.
ICMS_GROUPS = {
    "ICMS00": f"{ORIGIN} {OWN} pFCP vFCP",
    "ICMS02": f"{ORIGIN} {PER_UNIT}",
    "ICMS10": f"{ORIGIN} {OWN} {SUBSTITUTION} {FUND} {FUND_SUBSTITUTION} {RELIEF_SUBSTITUTION}",
    "ICMS15": f"{ORIGIN} {PER_UNIT} qBCMonoReten adRemICMSReten vICMSMonoReten",
    "ICMS20": f"{ORIGIN} {OWN} pRedBC {FUND} {RELIEF}",
    "ICMS30": f"{ORIGIN} {SUBSTITUTION} {FUND_SUBSTITUTION} {RELIEF}",
    "ICMS40": f"{ORIGIN} {RELIEF}",
    "ICMS51": f"{ORIGIN} {OWN} pRedBC {FUND} cBenefRBC pDif pFCPDif vFCPDif vFCPEfet vICMSDif vICMSOp",
    "ICMS53": f"{ORIGIN} {PER_UNIT} pDif vICMSMonoDif vICMSMonoOp",
    "ICMS60": f"{ORIGIN} {RETAINED} {EFFECTIVE}",
    "ICMS61": f"{ORIGIN} qBCMonoRet adRemICMSRet vICMSMonoRet",
    "ICMS70": f"{ORIGIN} {OWN} pRedBC {SUBSTITUTION} {FUND_SUBSTITUTION} {RELIEF} {RELIEF_SUBSTITUTION}",
    "ICMS90": f"{ORIGIN} {OWN} pRedBC {SUBSTITUTION} {FUND} {FUND_SUBSTITUTION} {RELIEF} {RELIEF_SUBSTITUTION}",
    "ICMSPart": f"{ORIGIN} {OWN} pRedBC {SUBSTITUTION} {FUND_SUBSTITUTION} pBCOp UFST",
    "ICMSST": f"{ORIGIN} {RETAINED} {EFFECTIVE} vBCSTDest vICMSSTDest",
    "ICMSSN101": f"{SIMPLES} {SIMPLES_CREDIT}",
    "ICMSSN102": SIMPLES,
    "ICMSSN201": f"{SIMPLES} {SUBSTITUTION} {FUND_SUBSTITUTION} {SIMPLES_CREDIT}",
    "ICMSSN202": f"{SIMPLES} {SUBSTITUTION} {FUND_SUBSTITUTION}",
    "ICMSSN500": f"{SIMPLES} {RETAINED} {EFFECTIVE}",
    "ICMSSN900": f"{SIMPLES} {OWN} pRedBC {SUBSTITUTION} {FUND_SUBSTITUTION} {SIMPLES_CREDIT}",
}


def contribution(tax: str, prefix: str = "") -> list[Group]:
    """PIS and COFINS: the same groups under two names."""
    by_rate, by_quantity = f"vBC p{tax}", "qBCProd vAliqProd"
    kinds = {
        f"{tax}Aliq": f"CST {by_rate} v{tax}",
        f"{tax}NT": "CST",
        f"{tax}Outr": f"CST {by_rate} {by_quantity} v{tax}",
        f"{tax}Qtde": f"CST {by_quantity} v{tax}",
    }
    substitution = f"indSoma{tax}ST {by_rate} {by_quantity} v{tax}"
    return [
        group(tax, "", *(group(kind, leaves, prefix=f"{prefix}{kind}") for kind, leaves in kinds.items())),
        group(f"{tax}ST", substitution, prefix=f"{prefix}{tax}ST"),
    ]


def monophase(kind: str, suffix: str) -> Group:
    taxes = " ".join(f"adRem{tax}{suffix} v{tax}Mono{suffix}" for tax in ("IBS", "CBS"))
    return group(kind, f"qBCMono{suffix} {taxes}")


ITEM_CONSUMPTION_TAX = consumption_tax(
    {**DEFERRED, **RETURNED, **REDUCED},
    leaves="CST cClassTrib indDoacao",
    total_prefix="IBSCBS_gIBSCBS",
    level_prefix="gIBSCBS_",
    within=[
        group("gTribRegular", REGULAR_TAX, prefix="gIBSCBS_gTribRegular"),
        group("gTribCompraGov", GOVERNMENT_PURCHASE_TAX),
    ],
    beside=[
        group(
            "gIBSCBSMono",
            "vTotIBSMonoItem vTotCBSMonoItem",
            monophase("gMonoPadrao", ""),
            monophase("gMonoReten", "Reten"),
            monophase("gMonoRet", "Ret"),
            group("gMonoDif", "pDifIBS vIBSMonoDif pDifCBS vCBSMonoDif"),
        ),
        group("gTransfCred", "vIBS vCBS"),
        group("gAjusteCompet", "competApur vIBS vCBS"),
        group(
            "gCredPresOper",
            "vBCCredPres cCredPres",
            *(group(f"g{tax}CredPres", "pCredPres vCredPres vCredPresCondSus") for tax in ("IBS", "CBS")),
        ),
        group("gCredPresIBSZFM", "competApur tpCredPresIBSZFM vCredPresIBSZFM"),
        group("gEstornoCred", "vIBSEstCred vCBSEstCred"),
    ],
)

PRODUCT = group(
    "prod",
    "CFOP CEST CNPJFab cBenefRBC NCM EXTIPI cBarra cBarraTrib cBenef cEAN cEANTrib cProd indBemMovelUsado indEscala indTot "
    "tpCredPresIBSZFM nFCI nItemPed nRECOPI qCom qTrib uCom uTrib vTotTrib vDesc vFrete vOutro vProd vSeg vUnCom vUnTrib "
    "xPed xProd xLote NVE[]",
    many(
        "DI",
        "CNPJ CPF UFDesemb UFTerceiro cExportador dDI dDesemb nDI tpIntermedio tpViaTransp vAFRMM xLocDesemb",
        many("adi", "cFabricante nAdicao nDraw nSeqAdic vDescDI"),
    ),
    many("gCred", "cCredPresumido pCredPresumido vCredPresumido"),
    group("infProdEmb", "qVolEmb uEmb xEmb"),
    group("infProdNFF", "cOperNFF cProdFisco"),
    many("med", "cProdANVISA vPMC xMotivoIsencao"),
    many("arma", "descr nCano nSerie tpArma"),
    group(
        "veicProd",
        "CMT VIN anoFab anoMod cCor cCorDENATRAN cMod chassi cilin condVeic dist espVeic lota nMotor nSerie pesoB pesoL pot "
        "tpComb tpOp tpPint tpRest tpVeic xCor",
    ),
    many("detExport", "nDraw", group("exportInd", "chNFe nRE qExport")),
    group(
        "comb",
        "CODIF UFCons cProdANP descANP pBio pGLP pGNi pGNn qTemp vPart",
        group("CIDE", "qBCProd vAliqProd vCIDE", prefix="comb_CIDE"),
        group("encerrante", "nBico nBomba nTanque vEncFin vEncIni"),
        many("origComb", "cUFOrig indImport pOrig"),
    ),
    many("rastro", "cAgreg dFab dVal nLote qLote"),
    prefix="",
)

TAXES = group(
    "imposto",
    "vTotTrib",
    group("ICMS", "", *(group(name, leaves) for name, leaves in ICMS_GROUPS.items())),
    group(
        "ICMSUFDest",
        "pFCPUFDest pICMSInter pICMSInterPart pICMSUFDest vBCFCPUFDest vBCUFDest vFCPUFDest vICMSUFDest vICMSUFRemet",
    ),
    *contribution("COFINS"),
    group("II", "vBC vDespAdu vII vIOF"),
    group(
        "IPI",
        "CNPJProd cEnq cSelo qSelo",
        group("IPINT", "CST"),
        group("IPITrib", "CST pIPI qUnid vBC vIPI vUnid"),
    ),
    group(
        "ISSQN",
        "cListServ cMun cMunFG cPais cServico indISS indIncentivo nProcesso vAliq vBC vDeducao vDescCond vDescIncond vOutro "
        "vISSQN vISSRet",
    ),
    group("IS", "CSTIS cClassTribIS vBCIS pIS pISEspec uTrib qTrib vIS"),
    *contribution("PIS", prefix="PIS_"),
    ITEM_CONSUMPTION_TAX,
)

ITEM = Group(
    "det",
    ("_nItem", "vItem", "infAdProd"),
    (
        many("DFeReferenciado", "chaveAcesso nItem"),
        PRODUCT,
        TAXES,
        group("impostoDevol", "pDevol", group("IPI", "vIPIDevol", prefix="impostoDevol_IPI")),
        group("obsItem", "", *observations("obsCont", "obsFisco")),
    ),
    repeated=True,
    prefix="",
)

ITEMS = Layout(
    root=group(
        "",
        "",
        group("protNFe", "", group("infProt", "chNFe cStat dhRecbto", names={"chNFe": "chave"})),
        prefix="",
    ),
    exploded=("NFe", "infNFe"),
    item=ITEM,
)
