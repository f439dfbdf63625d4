"""Events and cancellations of every family: a request (``evento*``) and, once answered, a reply (``retEvento*``)."""

from __future__ import annotations

from fisclake.layouts.shared import CONNECTION, CONNECTION_NAMES
from fisclake.layouts.tree import Group, Layout, document, group, many, whole

REQUEST_TAIL = "dhEvento nSeqEvento tpAmb tpEvento"
REPLY = "_Id cOrgao cStat dhRegEvento nProt nSeqEvento tpAmb tpEvento verAplic xEvento xMotivo"
CANCELLED = "descEvento nProt xJust"


def reply(name: str, key: str, leaves: str = REPLY, key_column: str = "chave", prefix: str | None = None,
          version: str | None = None) -> Group:
    prefix = name if prefix is None else prefix
    return group(
        name,
        "_versao",
        group("infEvento", f"{leaves} {key}", prefix=prefix, names={key: key_column}),
        prefix=prefix,
        names={"_versao": version} if version else None,
    )


def event(family: str, details: list[Group], version: str = "versao", connection: bool = True) -> Layout:
    """Event of one family; its key comes from the reply, so an unanswered event has none."""
    key = f"ch{family}"
    return document(
        group(
            f"evento{family}",
            "_versao",
            group(
                "infEvento",
                f"CNPJ _Id cOrgao {key} {REQUEST_TAIL}",
                group("detEvento", "_versaoEvento", *details),
            ),
        ),
        reply(f"retEvento{family}", key),
        leaves=CONNECTION if connection else "",
        names={**CONNECTION_NAMES, "_versao": version} if connection else None,
    )


BPE = event(
    "BPe",
    [
        group("evCancBPe", CANCELLED),
        group("evAlteracaoPoltrona", "descEvento nProt poltrona"),
        group("evExcessoBagagem", "descEvento nProt qBagagem vTotBag"),
        group("evNaoEmbBPe", CANCELLED),
        group("evSubBPe", "chBPeSubstituto descEvento dhRecbto nProt tpSub"),
    ],
    version="versao_layout",
)
MDFE = event("MDFe", [group("evCancMDFe", CANCELLED)])
NF3E = event(
    "NF3e",
    [group("evCancNF3e", f"{CANCELLED} chNF3eSubstituta", names={"chNF3eSubstituta": "chNF3eSubstituta"})],
    connection=False,
)
NFCOM = event(
    "NFCom",
    [group("evCancNFCom", f"{CANCELLED} chNFComAjuste"), group("evSubNFCom", f"{CANCELLED} chNFComSubstituta")],
)

# Transport events that name one other document, and the leaf that names it (fixed values).
CTE_LINKS = {
    "evCTeComplementar": "chCTeCompl",
    "evCTeMultimodal": "chCTeVinculado",
    "evCTeRedespacho": "chCTeRedesp",
    "evCTeRedespachoInter": "chCTeRedespInter",
    "evCTeSubcontratacao": "chCTeSubcon",
    "evCTeSubstituido": "chCTeSubstituicao",
    "evCancCTeComplementar": "chCTeCompl",
    "evGTVeAutorizadoCTeOS": "chCTeOS",
}
DELIVERED = many("infEntrega", "chNFe")

CTE_DETAILS = [
    group("evCancCTe", CANCELLED),
    group(
        "evCCeCTe",
        "descEvento xCondUso",
        many("infCorrecao", "campoAlterado grupoAlterado nroItemAlterado valorAlterado"),
    ),
    group("evCECTe", "descEvento dhEntrega dhHashEntrega hashEntrega latitude longitude nDoc nProt xNome", DELIVERED),
    group(
        "evCTeAutorizadoMDFe",
        "descEvento",
        group("MDFe", "chMDFe dhEmi dhRecbto modal nProt", prefix="evCTeAutorizadoMDFe"),
        group("emit", "CNPJ CPF IE xNome", prefix="evCTeAutorizadoMDFe_emit"),
    ),
    group("evCTeCanceladoMDFe", "descEvento", group("MDFe", "chMDFe nProtCanc", prefix="evCTeCanceladoMDFe")),
    *(group(name, f"{link} descEvento dhRecbto nProt") for name, link in CTE_LINKS.items()),
    group(
        "evCTeRegPassagem",
        "CPFFunc cUFTransito cUnidFiscal chMDFe descEvento dhPass latitude longitude placa tpSentido tpTransm xFunc xObs "
        "xUnidFiscal",
    ),
    group(
        "evCTeRegPassagemAuto",
        "chMDFe descEvento tpTransm",
        group(
            "infPass",
            "NSU cIdEquip cUFTransito dhPass latitude longitude placa tpEquip tpSentido xIdEquip",
            prefix="evCTeRegPassagemAuto",
        ),
    ),
    group("evCTeRegPassagemAutoMDFe", "chMDFe descEvento"),
    group("evCancCECTe", "descEvento nProt nProtCE"),
    group("evCancIECTe", "descEvento nProt nProtIE"),
    group("evCancPrestDesacordo", "descEvento nProtEvPrestDes"),
    group(
        "evIECTe",
        "descEvento dhHashTentativaEntrega dhTentativaEntrega hashTentativaEntrega nProt tpMotivo xJustMotivo",
        DELIVERED,
    ),
    group("evPrestDesacordo", "descEvento indDesacordoOper xObs"),
]

# Transport events take the key from the request, so it is there before the reply is.
CTE = document(
    group(
        "eventoCTe",
        "_xmlns _Id _versao",
        group(
            "infEvento",
            f"CNPJ CPF _Id cOrgao chCTe {REQUEST_TAIL}",
            group("detEvento", "_versaoEvento", *CTE_DETAILS),
            names={"chCTe": "chave"},
        ),
    ),
    reply("retEventoCTe", "chCTe", key_column="retInfEvento_chCTe", prefix="retInfEvento", version="retEvento_versao"),
    leaves=CONNECTION,
    names=CONNECTION_NAMES,
)

NFE = document(
    group(
        "evento",
        "_versao",
        group(
            "infEvento",
            f"CNPJ CPF _Id cOrgao chNFe {REQUEST_TAIL} verEvento",
            group(
                "detEvento",
                "_versao descEvento nProt xJust CPFOper IE PINe UFDest cOrgaoAutor cPostoUF chCTe chMDFe chNFeRefte "
                "dPrevEntrega dVistoria dhEmi dhEntrega dhHashComprovante dhHashTentativaEntrega dhPas dhTentativaEntrega "
                "hashComprovante hashTentativaEntrega indOffline indQuitacao indRet latGPS locVistoria longGPS nDoc nProtCTeCanc "
                "nProtEvento nTentativa postoVistoria sentidoVia tpAutor tpEventoAut tpMotivo tpNF verAplic xCondUso xCorrecao "
                "xHistorico xJustMotivo xNome xNomeOper xObs xPostoUF",
                whole(
                    "CTe",
                    "chCTe dhEmi dhEntrega dhHashEntregaCTe dhRecbto hashEntregaCTe latGPS longGPS modal nDoc nProt nProtCTe "
                    "nProtCanc xNome",
                ),
                whole("MDFe", "chCTe chMDFe dhEmi dhRecbto modal nProt nProtCanc"),
                whole("ctg", "CNPJDest UFDest diaEmi indICMS indICMSST tpEmis vTotalNFe"),
                whole("dest", "CNPJ CPF IE UF vICMS vNF vST"),
                whole("emit", "CNPJ CPF IE xNome"),
                whole("modalOutro", "tpModal"),
                whole("modalRodov", "UFCarreta UFCarreta2 UFVeic placaCarreta placaCarreta2 placaVeic"),
                many("detPag", "CNPJIF CNPJPag CNPJReceb UFPag UFReceb cAut dPag indPag tBand tPag vPag xPag"),
                many("gImobilizacao", "_nItem vCBS vIBS", group("gControleEstoque", "qImobilizado uImobilizado")),
                many(
                    "itensAverbados",
                    "dhAverbacao dhEmbarque motAlteracao nDue nItem nItemDue qItem",
                    group("enquad", "cEnq[]"),
                ),
            ),
        ),
    ),
    reply("retEvento", "chNFe", f"{REPLY} CNPJDest CPFDest cOrgaoAutor chCTe chMDFe emailDest"),
    leaves="_versao _xmlns",
    names={"_versao": "parsed_versao", "_xmlns": "parsed_xmlns"},
)

NFCE = document(
    group(
        "infEvento",
        f"CNPJ _Id cOrgao chNFe {REQUEST_TAIL} verEvento",
        group("detEvento", "_versao cOrgaoAutor chNFeRef descEvento nProt tpAutor verAplic xJust"),
    ),
    reply(
        "retEvento",
        "chNFe",
        "CNPJDest cOrgao cStat dhRegEvento emailDest nProt nSeqEvento tpAmb tpEvento verAplic xMotivo",
    ),
)
