"""Target tables: columns, keys and rules."""

from __future__ import annotations

from quillon.operators.merge import TableSpec

COMPANIES = TableSpec("companies", ("cnpj",), "cnpj string, ticker string, codigo_cvm string, nome string, setor string, status_cvm string, observacao string, created_at timestamp, updated_at timestamp", ("cnpj", "ticker", "nome"), (("ticker",),))
DOCUMENTS = TableSpec("ipe_docs", ("protocolo_entrega",), "protocolo_entrega string, cnpj_companhia string, nome_companhia string, codigo_cvm string, data_referencia date, data_entrega date, categoria string, tipo string, especie string, assunto string, tipo_apresentacao string, versao int, link_download string, ano int, texto_extraido string, extracao_falhou int, extraido_em timestamp, created_at timestamp, updated_at timestamp", ("protocolo_entrega", "cnpj_companhia"))
POSITIONS = TableSpec("vlmo_posicao", ("protocolo_entrega",), "protocolo_entrega string, cnpj_companhia string, nome_companhia string, data_referencia date, versao int, codigo_cvm string, categoria string, tipo string, data_entrega date, tipo_apresentacao string, motivo_reapresentacao string, link_download string, created_at timestamp", ("protocolo_entrega", "cnpj_companhia"))
MOVEMENTS = TableSpec("vlmo_movimentacoes", ("cnpj_companhia", "data_referencia", "versao", "tipo_cargo", "tipo_movimentacao", "tipo_operacao", "tipo_ativo", "data_movimentacao", "quantidade", "preco_unitario"), "cnpj_companhia string, nome_companhia string, data_referencia date, versao int, tipo_empresa string, empresa string, tipo_cargo string, tipo_movimentacao string, descricao_movimentacao string, tipo_operacao string, tipo_ativo string, caracteristica_valor_mobiliario string, intermediario string, data_movimentacao date, quantidade long, preco_unitario double, volume double, created_at timestamp", ("cnpj_companhia",))
PROGRAMMES = TableSpec("recompra_programas", ("id_programa",), "id_programa string, cnpj_companhia string, nome_companhia string, quantidade_acoes_ordinarias long, quantidade_acoes_preferenciais long, finalidade_compra string, data_deliberacao date, motivo string, data_final_prazo date, situacao string, created_at timestamp, updated_at timestamp", ("id_programa", "cnpj_companhia"))
_OF_PROGRAMME = ((("id_programa",), PROGRAMMES, ("id_programa",)),)
AMOUNTS = TableSpec("recompra_quantidades", ("id_programa", "cnpj_companhia", "data_referencia", "tipo_ativo"), "id_programa string, cnpj_companhia string, data_referencia date, tipo_ativo string, quantidade long, preco_medio double, volume double, created_at timestamp", ("cnpj_companhia",), references=_OF_PROGRAMME)
BROKERS = TableSpec("recompra_intermediarios", ("id_programa", "cnpj_companhia", "intermediario"), "id_programa string, cnpj_companhia string, intermediario string, created_at timestamp", ("cnpj_companhia",), references=_OF_PROGRAMME)
_BY_YEAR = ("year(data_referencia)",)
_FRE = "cnpj_companhia string, nome_companhia string, data_referencia date, versao int, id_documento string"
CAPITAL = TableSpec("fre_capital_social", ("cnpj_companhia", "data_referencia", "versao", "id_capital_social"), f"{_FRE}, id_capital_social string, tipo_capital string, data_autorizacao_aprovacao date, valor_capital double, quantidade_acoes_ordinarias long, quantidade_acoes_preferenciais long, quantidade_total_acoes long, created_at timestamp", ("cnpj_companhia",), parts=_BY_YEAR)
HOLDERS = TableSpec("fre_posicao_acionaria", ("cnpj_companhia", "data_referencia", "versao", "id_acionista"), f"{_FRE}, id_acionista string, acionista string, tipo_pessoa_acionista string, quantidade_acao_ordinaria_circulacao long, quantidade_acao_preferencial_circulacao long, quantidade_total_acoes_circulacao long, percentual_acao_ordinaria_circulacao double, percentual_acao_preferencial_circulacao double, percentual_total_acoes_circulacao double, nacionalidade string, residente_exterior string, acionista_controlador string, participante_acordo_acionistas string, data_composicao_capital_social date, created_at timestamp", ("cnpj_companhia",), parts=_BY_YEAR)
PAY = TableSpec("fre_remuneracao_orgao", ("cnpj_companhia", "data_referencia", "versao", "data_inicio_exercicio_social", "data_fim_exercicio_social", "orgao_administracao"), f"{_FRE}, data_inicio_exercicio_social date, data_fim_exercicio_social date, orgao_administracao string, numero_membros double, numero_membros_remunerados double, valor_maior_remuneracao double, valor_menor_remuneracao double, valor_medio_remuneracao double, observacao string, created_at timestamp", ("cnpj_companhia",), parts=_BY_YEAR)
STATEMENTS = TableSpec("demonstrativos_contabeis", ("cnpj_companhia", "fonte", "tipo_doc", "data_referencia", "versao", "ordem_exercicio", "cd_conta"), "cnpj_companhia string, fonte string, tipo_doc string, data_referencia date, versao int, ordem_exercicio string, dt_ini_exerc date, dt_fim_exerc date, cd_conta string, ds_conta string, vl_conta double", ("cnpj_companhia", "fonte", "tipo_doc", "data_referencia", "versao", "ordem_exercicio", "cd_conta"), (), {"ordem_exercicio": ("Último", "Penúltimo"), "fonte": ("DFP", "ITR")}, parts=("fonte", "tipo_doc", *_BY_YEAR))
TABLES = (COMPANIES, DOCUMENTS, POSITIONS, MOVEMENTS, PROGRAMMES, AMOUNTS, BROKERS, CAPITAL, HOLDERS, PAY, STATEMENTS)
