"""Utility bills: electricity (NF3-e) and communication services (NFCom)."""

from __future__ import annotations

from fisclake.layouts.shared import (
    CONNECTION,
    CONNECTION_NAMES,
    DEFERRED,
    GOVERNMENT_PURCHASE_TAX,
    PLACE,
    PLACE_ABROAD,
    RETURNED,
    TECHNICAL_CONTACT_SIGNED,
    consumption_tax,
    consumption_tax_totals,
    protocol,
)
from fisclake.layouts.tree import document, group, many

GOVERNMENT = "tpOperGov pRedutor tpEnteGov"
NF3E_GOVERNMENT_PURCHASE = group("gCompraGov", GOVERNMENT, prefix="ide_gCompraGov", types={"pRedutor": "string"})
NFCOM_GOVERNMENT_PURCHASE = group(
    "gCompraGov", GOVERNMENT, prefix="ide_gCompraGov", types={"tpOperGov": "bigint", "tpEnteGov": "bigint"}
)
#: Rates that NF3-e keeps as text.
NF3E_RATES = {f"pAliq{tax}": "string" for tax in ("IBSUF", "IBSMun", "CBS")}
WITHHELD = group("vRetTribTot", "vIRRF vRetCSLL vRetCofins vRetPIS")
WITHHELD_ITEM = group("retTrib", "vBCIRRF vIRRF vRetCSLL vRetCofins vRetPIS")
POSTAL = f"{PLACE} fone"
TARIFF = "dIniTarif dFimTarif tpAto nAto anoAto tpTarif cPosTarif uMed vTarifHom vTarifAplic motDifTarif"
BAND = "dIniAdBand dFimAdBand tpBand vAdBand"

NF3E_ITEM_TAX = group(
    "imposto",
    "indSemCST",
    group("COFINS", "CST pCOFINS vBC vCOFINS"),
    group("COFINSEfet", "pCOFINSEfet vBCCOFINSEfet vCOFINSEfet"),
    consumption_tax({**DEFERRED, **RETURNED}, within=[group("gTribCompraGov", GOVERNMENT_PURCHASE_TAX, types=NF3E_RATES)]),
    group("ICMS00", "orig CST vBC pICMS vICMS pFCP vFCP"),
    group("ICMS40", "CST cBenef vICMSDeson"),
    group(
        "ICMS60",
        "orig CST vBCSTRet pST vICMSSubstituto vICMSSTRet vBCFCPSTRet pFCPSTRet vFCPSTRet pRedBCEfet vBCEfet pICMSEfet vICMSEfet",
    ),
    group("ICMS90", "orig CST vBC pICMS vICMS"),
    group("PIS", "CST pPIS vBC vPIS"),
    group("PISEfet", "pPISEfet vBCPISEfet vPISEfet"),
    WITHHELD_ITEM,
)

NF3E_ITEMS = group(
    "NFdet",
    "",
    many(
        "det",
        "_nItem",
        group(
            "detItem",
            "",
            many("gAdBand", BAND),
            many("gContab", "cContab tpLanc vContab xContab"),
            many("gTarif", TARIFF),
            NF3E_ITEM_TAX,
            group(
                "prod",
                "CFOP cClass cProd indDevolucao indOrigemQtd qFaturada uMed vItem vProd xProd",
                group(
                    "gMedicao",
                    "nContrat nMed tpMotNaoLeitura",
                    group(
                        "gMedida",
                        "cPosTarif pPerdaTran tpGrMed uMed vConst vMed vMedAnt vMedAtu vMedPerdaTec vMedPerdaTran",
                    ),
                ),
            ),
        ),
    ),
)

NF3E = document(
    group(
        "NF3e",
        "",
        group(
            "infNF3e",
            "_Id _versao",
            NF3E_ITEMS,
            many("autXML", "CNPJ CPF", column="autxml"),
            group(
                "acessante",
                "idAcesso idCodCliente latGPS longGPS tpAcesso tpClasse tpFase tpGrpTensao tpModTar tpSubClasse xNomeUC",
            ),
            group("dest", "CNPJ CPF IE NB cNIS idOutros indIEDest xNome", group("enderDest", POSTAL)),
            group("emit", "CNPJ IE xFant xNome", group("enderEmit", POSTAL)),
            group(
                "gANEEL",
                "",
                many("gHistFat", "xGrandFat", many("gGrandFat", "CompetFat qtdDias uMed vFat")),
            ),
            group(
                "gFat",
                "CompetFat codBarras codDebAuto dApresFat dProxLeitura dVencFat nFat",
                group("enderCorresp", POSTAL),
                group("gPIX", "urlQRCodePIX"),
            ),
            many("gGrContrat", "_nContrat qUnidContrat tpGrContrat tpPosTar", column="ggrcontrat"),
            group("gMed", "_nMed dMedAnt dMedAtu idMedidor"),
            group(
                "gSCEE",
                "tpPartComp",
                many("gConsumidor", "idAcessGer vPotInst tpFonteEnergia enerAloc tpPosTar"),
                many("gSaldoCred", "tpPosTar vSaldAnt vCredExpirado vSaldAtual vCredExpirar CompetExpirar"),
            ),
            many("gTarif", TARIFF, column="gtarif"),
            many("gAdBand", f"{BAND} vAdBandAplic motDifBand", column="gadband"),
            group("gRespTec", TECHNICAL_CONTACT_SIGNED),
            group("gSub", "chNF3e motSub", group("gNF", "CNPJ CompetApur CompetEmis hash115 nNF serie")),
            group(
                "ide",
                "cDV cMunFG cNF cUF dhCont dhEmi finNF3e mod nNF nSiteAutoriz serie tpAmb tpEmis verProc xJust",
                NF3E_GOVERNMENT_PURCHASE,
            ),
            group(
                "total",
                "vCOFINS vCOFINSEfet vNF vPIS vPISEfet vProd vTotDFe",
                group(
                    "IBSCBSTot",
                    "vBCIBSCBS",
                    group("gCBS", "vCBS vDevTrib vDif"),
                    group(
                        "gIBS",
                        "vIBS",
                        group("gIBSMun", "vDevTrib vDif vIBSMun", prefix="gibs_gibsmun"),
                        group(
                            "gIBSUF",
                            "vDevTrib vDif vIBSUF",
                            prefix="gibs_gibsup",
                            names={"vIBSUF": "gibs_gibsup_vibsup"},
                        ),
                    ),
                ),
                group("ICMSTot", "vBC vBCST vFCP vFCPST vICMS vICMSDeson vST"),
                WITHHELD,
            ),
            names={"_Id": "nfdet_id"},
        ),
        group("infNF3eSupl", "qrCodNF3e"),
    ),
    protocol("protNF3e", "chNF3e"),
    leaves=CONNECTION,
    names=CONNECTION_NAMES,
)

NFCOM_ITEM = many(
    "det",
    "_chNFComAnt _nItem _nItemAnt infAdProd",
    group("prod", "cProd xProd cClass CFOP CNPJLD uMed qFaturada vItem vDesc vOutro vProd dExpiracao indDevolucao"),
    group(
        "imposto",
        "indSemCST",
        group("COFINS", "CST vBC pCOFINS vCOFINS"),
        group("FUNTTEL", "vBC pFUNTTEL vFUNTTEL"),
        group("FUST", "vBC pFUST vFUST"),
        consumption_tax(RETURNED, leaves="CST cClassTrib indDoacao"),
        group("ICMS00", "CST vBC pICMS vICMS pFCP vFCP"),
        group("ICMS20", "CST pRedBC vBC pICMS vICMS vICMSDeson cBenef pFCP vFCP"),
        group("ICMS40", "CST cBenef vICMSDeson"),
        group("ICMS51", "CST vICMSDeson cBenef"),
        group("ICMS60", "CST vBCSTRet pST vICMSSTRet"),
        group("ICMS90", "CST vBC pICMS vICMS vICMSDeson cBenef pFCP vFCP"),
        group("ICMSSN", "CST indSN"),
        group(
            "ICMSUFDest",
            "cUFDest vBCUFDest pFCPUFDest pICMSUFDest vFCPUFDest vICMSUFDest vICMSUFEmi cBenefUFDest",
        ),
        group("PIS", "CST pPIS vBC vPIS"),
        WITHHELD_ITEM,
    ),
    group(
        "gProcRef",
        "vItem qFaturada vProd vDesc vOutro indDevolucao vBC pICMS vICMS vPIS vCOFINS vFCP",
        group("gProc", "tpProc nProcesso"),
    ),
    group("gRessarc", "tpRessarc dRef nProtReclama nProcesso xObs"),
    column="det",
)

NFCOM = document(
    group(
        "NFCom",
        "",
        group(
            "infNFCom",
            "_Id _versao",
            group(
                "assinante",
                "NroTermAdic[] NroTermPrinc cUFAdic[] cUFPrinc dContratoFim dContratoIni iCodAssinante nContrato tpAssinante "
                "tpServUtil",
            ),
            group("gSub", "chNFCom motSub", group("gNF", "CNPJ mod serie nNF CompetEmis hash115")),
            group("gCofat", "chNFComLocal"),
            group("autXML", "CNPJ CPF"),
            group("dest", "xNome CNPJ CPF idOutros indIEDest IE IM", group("enderDest", f"{PLACE_ABROAD} email fone")),
            NFCOM_ITEM,
            group("emit", "CNPJ IE IEUFDest CRT xNome xFant", group("enderEmit", f"{PLACE} email fone")),
            group(
                "gFat",
                "CompetFat codAgencia codBanco codBarras codDebAuto dPerUsoFim dPerUsoIni dVencFat",
                group("enderCorresp", f"{PLACE} email fone"),
                group("gPIX", "urlQRCodePIX", names={"urlQRCodePIX": "gfat_gpix_urlqrcode"}),
            ),
            group("gFatCentral", "CNPJ cUF"),
            group("gFidelidade", "dRefResgPts dRefSaldoPts qtdPtsResg qtdSaldoPts"),
            group("gRespTec", TECHNICAL_CONTACT_SIGNED),
            group(
                "ide",
                "cDV cMunFG cNF cUF dhEmi dhCont finNFCom indCessaoMeiosRede indNotaEntrada indPrePago mod nNF nSiteAutoriz serie "
                "tpAmb tpEmis tpFat verProc xJust",
                NFCOM_GOVERNMENT_PURCHASE,
            ),
            group("infAdic", "infAdFisco infCpl[]"),
            group(
                "total",
                "vCOFINS vDesc vFUNTTEL vFUST vNF vOutro vPIS vProd vTotDFe",
                consumption_tax_totals(
                    group("gEstornoCred", "vIBSEstCred vCBSEstCred", prefix="ibscbstot_gestornocred"),
                    path="ibscbstot_",
                ),
                group("ICMSTot", "vBC vFCP vICMS vICMSDeson"),
                WITHHELD,
            ),
        ),
        group("infNFComSupl", "qrCodNFCom"),
    ),
    protocol("protNFCom", "chNFCom"),
    leaves=CONNECTION,
    names=CONNECTION_NAMES,
)
