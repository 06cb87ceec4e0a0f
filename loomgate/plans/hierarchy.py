"""Foreign-key graph of a table family: levels, paths, discovery."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Edge:
    """``table.column`` refers to ``parent.parent_key``."""

    table: str
    column: str
    parent: str
    parent_key: str


@dataclass
class Table:
    name: str
    level: int
    key: str
    parents: dict[str, str] = field(default_factory=dict)  # column -> parent table
    external: tuple[str, ...] = ()

    @property
    def key_is_reference(self) -> bool:
        """The primary key is itself a reference to another table's key."""
        return self.parents.get(self.key, self.name) != self.name


# Table, level, primary key, foreign keys (column: parent), columns
# that point outside the family.
FAMILY = (
    Table("tCompany", 0, "CompanySID", {"DefaultExposureSetSID": "tExposureSet"}, ("BusinessUnitSID",)),
    Table("tPortfolioFilter", 0, "PortfolioFilterSID"),
    Table("tAppliesToArea", 0, "AppliesToAreaSID"),
    Table("tReinsuranceEPCurveSet", 0, "ReinsuranceEPCurveSetSID", {"CompanySID": "tCompany"}, ("CurrencyExchangeRateSetSID", "ReinsuranceEventSetSID", "ULFCurrencyExchangeRateSetSID")),
    Table("tSIDControl", 0, "TableSID"),
    Table("tExposureSet", 1, "ExposureSetSID", {"CompanySID": "tCompany"}),
    Table("tReinsuranceProgram", 1, "ReinsuranceProgramSID", {"CompanySID": "tCompany"}, ("BusinessUnitSID", "CurrencyExchangeRateSetSID", "ProjectSID")),
    Table("tPortfolio", 1, "PortfolioSID", {"PortfolioFilterSID": "tPortfolioFilter"}, ("BusinessUnitSID",)),
    Table("tReinsuranceEPCurve", 1, "ReinsuranceEPCurveSID", {"ReinsuranceEPCurveSetSID": "tReinsuranceEPCurveSet", "AppliesToAreaSID": "tAppliesToArea"}),
    Table("tCompanyCatBondImportHistory", 1, "CompanyCatBondImportHistorySID", {"CompanySID": "tCompany"}),
    Table("tCompanyUDCClassification_Xref", 1, "CompanySID", {"CompanySID": "tCompany"}, ("UDCClassificationSID",)),
    Table("tContract", 2, "ContractSID", {"ExposureSetSID": "tExposureSet"}),
    Table("tReinsuranceTreaty", 2, "ReinsuranceTreatySID", {"ReinsuranceProgramSID": "tReinsuranceProgram", "AppliesToAreaSID": "tAppliesToArea"}),
    Table("tCompanyLossAssociation", 2, "CompanyLossAssociationSID", {"CompanySID": "tCompany", "ParentCompanyLossAssociationSID": "tCompanyLossAssociation"}, ("CompanyLossSetSID", "SourceBusinessUnitSID", "SqlInstanceSID")),
    Table("tReinsuranceProgramCoverage", 2, "ReinsuranceProgramSID", {"ReinsuranceProgramSID": "tReinsuranceProgram"}),
    Table("tReinsuranceProgramEPAdjustment", 2, "ReinsuranceProgramSID", {"ReinsuranceProgramSID": "tReinsuranceProgram"}),
    Table("tReinsuranceProgramEPAdjustmentPoints", 2, "ReinsuranceProgramSID", {"ReinsuranceProgramSID": "tReinsuranceProgram"}),
    Table("tReinsuranceProgramJapanCFLRatio", 2, "ReinsuranceProgramSID", {"ReinsuranceProgramSID": "tReinsuranceProgram"}, ("GeographySID", "ReinsuranceEventSetSID")),
    Table("tReinsuranceProgramSourceInure", 2, "ReinsuranceProgramSubjectSID", {"ReinsuranceProgramSourceInureSID": "tReinsuranceProgram", "ReinsuranceProgramSubjectSID": "tReinsuranceProgram"}),
    Table("tReinsuranceProgramTargetXRef", 2, "ReinsuranceProgramSID", {"ReinsuranceProgramSID": "tReinsuranceProgram", "ExposureSetSID": "tExposureSet", "CompanyLossAssociationSID": "tCompanyLossAssociation"}, ("YearSID",)),
    Table("tCatBondAttributeValue", 2, "ReinsuranceProgramSID", {"ReinsuranceProgramSID": "tReinsuranceProgram"}, ("CatBondAttributeSID",)),
    Table("tReinsAppliesToExp", 2, "ReinsAppliesToExpSID", {"ExposureSetSID": "tExposureSet"}, ("ReinsTargetSID",)),
    Table("tReinsuranceExposureAdjustmentFactor", 2, "ReinsuranceExposureAdjustmentFactorSID", {"ExposureSetSID": "tExposureSet"}),
    Table("tAggregateExposure", 2, "AggregateExposureSID", {"ExposureSetSID": "tExposureSet"}, ("GeographySID",)),
    Table("tReinsuranceEPCurveAdjustmentPoint", 2, "ReinsuranceEPCurveSID", {"ReinsuranceEPCurveSID": "tReinsuranceEPCurve"}),
    Table("tLocation", 3, "LocationSID", {"ContractSID": "tContract", "ExposureSetSID": "tExposureSet", "ParentLocationSID": "tLocation"}, ("GeographySID",)),
    Table("tLayer", 3, "LayerSID", {"ContractSID": "tContract"}),
    Table("tStepFunction", 3, "StepFunctionSID", {"ContractSID": "tContract"}),
    Table("tAppliesToEventFilter", 3, "AppliesToEventFilterSID", {"ReinsuranceTreatySID": "tReinsuranceTreaty"}),
    Table("tReinsuranceTreatyReinstatement", 3, "ReinsuranceTreatyReinstatementSID", {"ReinsuranceTreatySID": "tReinsuranceTreaty"}),
    Table("tReinsuranceTreatySavedResults", 3, "ReinsuranceTreatySavedResultsID", {"ReinsuranceTreatySID": "tReinsuranceTreaty"}, ("CurrencyExchangeRateSetSID", "EventBasedAdjFactorSetSID")),
    Table("tReinsuranceTreatyTerrorismOption", 3, "ReinsuranceTreatySID", {"ReinsuranceTreatySID": "tReinsuranceTreaty"}),
    Table("tReinsuranceTreatyUDCClassification_Xref", 3, "ReinsuranceTreatySID", {"ReinsuranceTreatySID": "tReinsuranceTreaty"}, ("UDCClassificationSID",)),
    Table("tPortfolioReinsuranceTreaty", 3, "PortfolioSID", {"PortfolioSID": "tPortfolio", "ReinsuranceTreatySID": "tReinsuranceTreaty"}),
    Table("tCLFCatalog", 3, "CLFCatalogSID", {"CompanyLossAssociationSID": "tCompanyLossAssociation"}),
    Table("tCompanyLossMarketShare", 3, "CompanyLossMarketShareSID", {"CompanyLossAssociationSID": "tCompanyLossAssociation"}, ("CountrySID", "GeographySID")),
    Table("tCompanyCLASizes", 3, "CompanySID", {"CompanySID": "tCompany"}, ("CompanyLossSetSID",)),
    Table("tLayerCondition", 4, "LayerConditionSID", {"ContractSID": "tContract", "LayerSID": "tLayer", "ParentLayerConditionSID": "tLayerCondition"}),
    Table("tLocTerm", 4, "LocTermSID", {"ContractSID": "tContract", "LocationSID": "tLocation"}),
    Table("tLocFeature", 4, "LocationSID", {"LocationSID": "tLocation"}),
    Table("tLocOffshore", 4, "LocationSID", {"LocationSID": "tLocation"}),
    Table("tLocParsedAddress", 4, "LocationSID", {"LocationSID": "tLocation"}),
    Table("tLocWC", 4, "LocationSID", {"LocationSID": "tLocation"}),
    Table("tEngineLocPhysicalProperty", 4, "LocationSID", {"LocationSID": "tLocation"}),
    Table("tStepFunctionDetail", 4, "StepFunctionSID", {"StepFunctionSID": "tStepFunction"}),
    Table("tAppliesToEventFilterGeoXRef", 4, "AppliesToEventFilterSID", {"AppliesToEventFilterSID": "tAppliesToEventFilter"}, ("GeographySID",)),
    Table("tAppliesToEventFilterLatLong", 4, "AppliesToEventFilterSID", {"AppliesToEventFilterSID": "tAppliesToEventFilter"}),
    Table("tAppliesToEventFilterRule", 4, "AppliesToEventFilterRuleSID", {"AppliesToEventFilterSID": "tAppliesToEventFilter"}),
    Table("tProgramBusinessCategoryFactor", 4, "ContractSID", {"ContractSID": "tContract"}),
    Table("tLayerConditionLocationXref", 5, "LayerConditionSID", {"LayerConditionSID": "tLayerCondition", "LocationSID": "tLocation"}),
    Table("tLocStepFunctionXref", 5, "LocationSID", {"LocationSID": "tLocation", "StepFunctionSID": "tStepFunction"}),
    Table("tAppliesToAreaGeoXRef", 5, "AppliesToAreaSID", {"AppliesToAreaSID": "tAppliesToArea"}, ("GeographySID",)),
)


class Hierarchy:
    """Tables by name (case-insensitive lookup), with their foreign keys."""

    def __init__(self, tables: list[Table]):
        self.tables = {t.name: t for t in tables}
        self._by_lower = {t.name.lower(): t for t in tables}

    @classmethod
    def family(cls) -> Hierarchy:
        """The supplied family of tables."""
        return cls([replace(t, parents=dict(t.parents)) for t in FAMILY])

    @classmethod
    def discover(cls, columns: dict[str, list[str]], skip: tuple[str, ...] = ("exposuresetsid",)) -> Hierarchy:
        """Graph from column names: ``t{x}`` has key ``{x}sid``; a column ``{x}sid`` refers to ``t{x}``."""
        lower = {t.lower(): t for t in columns}
        tables = []
        for name, cols in columns.items():
            own = key_name(name)
            parents = {c: lower["t" + c.lower()[:-3]] for c in cols if c.lower().endswith("sid") and c.lower() not in (own, *skip) and "t" + c.lower()[:-3] in lower}
            tables.append(Table(name, 0, next((c for c in cols if c.lower() == own), own), parents))
        graph = cls(tables)
        graph.relevel()
        return graph

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._by_lower

    def __getitem__(self, name: str) -> Table:
        return self._by_lower[name.lower()]

    def relevel(self) -> None:
        """Levels from the graph: longest chain of parents (cycles are cut where met)."""
        def depth(name: str, seen: frozenset) -> int:
            up = [p for p in self[name].parents.values() if p != name and p not in seen and p in self]
            return 1 + max((depth(p, seen | {name}) for p in up), default=-1)

        for t in self.tables.values():
            t.level = depth(t.name, frozenset())

    def levels(self) -> dict[int, list[str]]:
        out: dict[int, list[str]] = {}
        for t in self.tables.values():
            out.setdefault(t.level, []).append(t.name)
        return dict(sorted(out.items()))

    def order(self, names: list[str] | None = None) -> list[str]:
        """Parents first, as declared within a level; unknown names come last."""
        if names is None:
            return [n for tables in self.levels().values() for n in tables]
        known = {self[n].name: n for n in names if n in self}
        return [known[n] for n in self.order() if n in known] + [n for n in names if n not in self]

    def edges(self, name: str) -> list[Edge]:
        return [Edge(name, c, p, self[p].key) for c, p in self[name].parents.items() if p in self]

    def path(self, table: str, to: set[str]) -> list[Edge] | None:
        """Shortest chain of references from ``table`` to one of ``to``; ties by declared order."""
        to = {t.lower() for t in to}
        queue, seen = deque([(self[table].name, [])]), {self[table].name}
        while queue:
            name, chain = queue.popleft()
            if name.lower() in to:
                return chain
            for e in self.edges(name):
                if e.parent not in seen:
                    seen.add(e.parent)
                    queue.append((self[e.parent].name, [*chain, e]))
        return None


def key_name(table: str) -> str:
    """``tLocation`` → ``locationsid``."""
    return (table[1:] if table[:1] in "tT" else table).lower() + "sid"
