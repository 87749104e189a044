"""Sector vocabulary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT = "Outros"

#: Registry sector names by watchlist sector.
SECTORS = {
    "Saude": ["Serviços Médicos", "Farmacêutico e Higiene", "Farmacêuticos e Outros", "Medicamentos", "Planos de Saúde", "Serv.Méd.Hospit..Análises e Diagnósticos"],
    "Industrial": ["Metalurgia e Siderurgia", "Emp. Adm. Part. - Metalurgia e Siderurgia", "Máquinas, Equipamentos, Veículos e Peças", "Emp. Adm. Part. - Máqs., Equip., Veíc. e Peças", "Máq. e Equip. Industriais", "Material de Construção", "Papel e Celulose", "Química", "Embalagens", "Petroquímicos e Borracha", "Vestuário e Calçados", "Motores . Compressores e Outros"],
    "Mobilidade": ["Serviços Transporte e Logística", "Emp. Adm. Part. - Serviços Transporte e Logística", "Aluguel de carros", "Transporte Rodoviário", "Transporte Ferroviário", "Logística", "Serviços de Logística"],
    "Agro": ["Agricultura (Açúcar, Álcool e Cana)", "Agricultura", "Produtos Agropecuários", "Sementes e Adubos", "Alimentos Processados", "Alimentos", "Emp. Adm. Part. - Alimentos", "Açúcar e Álcool"],
    "Educacao": ["Educação", "Emp. Adm. Part. - Educação"],
    "Infraestrutura": ["Saneamento, Serv. Água e Gás", "Emp. Adm. Part. - Saneamento, Serv. Água e Gás", "Exploração de Rodovias", "Água e Saneamento", "Transportes", "Serviços Portuários", "Aeroportos"],
    "Aviacao": ["Transporte Aéreo"],
    "Imobiliario": ["Construção Civil, Mat. Constr. e Decoração", "Emp. Adm. Part. - Const. Civil, Mat. Const. e Decoração", "Exploração de Imóveis", "Incorporações", "Construção Civil"],
    "Energia": ["Energia Elétrica", "Emp. Adm. Part. - Energia Elétrica", "Petróleo e Gás", "Emp. Adm. Part. - Petróleo e Gás", "Petróleo. Gás e Biocombustíveis", "Exploração. Refino e Distribuição"],
    "Telecom": ["Telecomunicações", "Emp. Adm. Part. - Telecomunicações"],
    "Financeiro": ["Bancos", "Emp. Adm. Part. - Bancos", "Seguradoras e Corretoras", "Emp. Adm. Part. - Seguradoras e Corretoras", "Intermediação Financeira", "Emp. Adm. Part. - Intermediação Financeira", "Arrendamento Mercantil", "Securitização de Recebíveis", "Bolsas de Valores/Mercadorias e Futuros", "Gestão de Recursos e Investimentos", "Emp. Adm. Part. - Financeiras", "Serviços Financeiros Especializados"],
    "Turismo": ["Hospedagem e Turismo", "Hotéis e Restaurantes", "Turismo e Lazer", "Operadoras e Agências", "Brinquedos e Lazer"],
    "Varejo": ["Comércio (Atacado e Varejo)", "Emp. Adm. Part. - Comércio (Atacado e Varejo)", "Eletrodomésticos", "Têxtil e Vestuário"],
    "Tecnologia": ["Comunicação e Informática", "Emp. Adm. Part. - Comunicação e Informática", "Programas e Serviços", "Tecnologia"],
    "Mineracao": ["Extração Mineral", "Emp. Adm. Part. - Extração Mineral", "Minerais Metálicos", "Mineração"],
}


def mapped(c: Column, table: dict[str, list[str]], default: str) -> Column:
    """The key whose list has the trimmed value, else ``default``; one case expression, no join."""
    out = F.lit(default)
    for name, values in table.items():
        out = F.when(F.trim(c).isin(*values), F.lit(name)).otherwise(out)
    return out


def sector(c: Column) -> Column:
    return mapped(c, SECTORS, DEFAULT)
