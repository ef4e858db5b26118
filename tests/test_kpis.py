"""KPI table, alerts and per-client KPIs on a small dataset."""

from pyspark.sql import Row

from portacube.plans import kpis as K


def _dataset(spark):
    rows = [Row(ID_Hecho=1, CodigoClienteReal=1, Presupuesto=100.0, CosteReal=90.0, PenalizacionesMonto=1.0,
                RetrasoFinalDias=0, Cancelado=0, PorcentajeTareasRetrasadas=10.0, PorcentajeHitosRetrasados=0.0,
                TasaDeExitoEnPruebas=1.0, ProductividadPromedio=800.0, AnioInicio=2020),
            Row(ID_Hecho=2, CodigoClienteReal=1, Presupuesto=100.0, CosteReal=120.0, PenalizacionesMonto=3.0,
                RetrasoFinalDias=5, Cancelado=1, PorcentajeTareasRetrasadas=30.0, PorcentajeHitosRetrasados=50.0,
                TasaDeExitoEnPruebas=0.5, ProductividadPromedio=200.0, AnioInicio=2021),
            Row(ID_Hecho=3, CodigoClienteReal=2, Presupuesto=50.0, CosteReal=0.0, PenalizacionesMonto=0.0,
                RetrasoFinalDias=-2, Cancelado=0, PorcentajeTareasRetrasadas=0.0, PorcentajeHitosRetrasados=0.0,
                TasaDeExitoEnPruebas=0.9, ProductividadPromedio=0.0, AnioInicio=2021)]
    return spark.createDataFrame(rows)


def test_kpi_table_a(spark):
    k = {r.kpi: r for r in K.kpi_table(_dataset(spark)).collect()}
    assert len(k) == 10
    assert k["cumplimiento_presupuesto"].valor == 66.67 and k["cumplimiento_presupuesto"].estado == "malo"
    assert k["proyectos_a_tiempo"].valor == 66.67
    assert k["proyectos_cancelados"].valor == 33.33 and k["proyectos_cancelados"].estado == "malo"
    assert k["productividad"].valor == 33.33
    assert k["exito_pruebas"].valor == 80.0 and k["exito_pruebas"].estado == "regular"
    assert k["penalizaciones"].descripcion.endswith("(OLAP)")


def test_alerts_and_by_client(spark):
    kpis = K.kpi_table(_dataset(spark))
    alerts = {r.kpi: r for r in K.alerts(kpis).collect()}
    assert alerts["cumplimiento_presupuesto"].severidad == "alta"
    assert alerts["cumplimiento_presupuesto"].recomendacion == "Revisar procesos relacionados con cumplimiento presupuesto"
    assert alerts["exito_pruebas"].recomendacion == "Monitorear exito pruebas de cerca"
    c = {r.CodigoClienteReal: r for r in K.kpis_by_client(_dataset(spark)).collect()}
    # client 1: compliance min(P/C,1)*100 -> (100 + 83.33)/2; client 2: zero cost counts as 100
    assert c[1].cumplimiento_presupuesto == 91.67 and c[2].cumplimiento_presupuesto == 100.0
    assert c[1].total_proyectos == 2 and c[1].proyectos_a_tiempo == 50.0
    badge = {r.CodigoClienteReal: r.badge for r in K.client_badge(K.kpis_by_client(_dataset(spark))).collect()}
    assert badge == {1: "good", 2: "good"}
