"""Published result tables of the source pipeline, copied as literals.

Fixed values (golden corpus): 10-fold F1 and ROC AUC scores per model, the
corrected and plain paired t-test outputs, and the hold-out confusion matrices
with the metrics computed from them.
"""

FOLD_MODELS = ["GaussianNB", "DecisionTree", "XGBoost", "KNN", "RandomForest", "AdaBoost"]

CV_F1 = [
    [0.16215155084413035, 0.474681578129854, 0.5747287364368219, 0.49395691014188126, 0.4895470383275261, 0.35360149672591207],
    [0.1604380824286675, 0.4710615908387496, 0.5977011494252874, 0.48221757322175735, 0.48021108179419525, 0.3616029822926375],
    [0.15848909657320873, 0.44340796019900497, 0.5816002819880155, 0.4826315789473684, 0.46819787985865724, 0.32494061757719717],
    [0.15229775921002658, 0.4587271581600504, 0.5854885057471264, 0.4703693861280893, 0.4960212201591512, 0.37541686517389233],
    [0.15599578907072448, 0.4583723105706268, 0.5955983493810179, 0.49427679500520294, 0.4872471416007036, 0.35694050991501414],
    [0.16129032258064516, 0.4756657483930211, 0.6070091867982307, 0.5020942408376964, 0.5160462130937099, 0.3957662218131615],
    [0.1601161665053243, 0.45714285714285713, 0.5844245348035837, 0.48715313463514903, 0.5108979947689625, 0.3520992366412214],
    [0.1585081585081585, 0.46365914786967416, 0.5862917398945519, 0.47886570358480474, 0.48857644991212656, 0.34978843441466856],
    [0.15710843373493977, 0.4646153846153846, 0.5819070904645477, 0.49088507265521797, 0.49393414211438474, 0.3767441860465116],
    [0.1579778830963665, 0.4536525475751995, 0.5736217725052338, 0.4784191367654706, 0.4783180026281209, 0.33810888252148996],
]

CORRECTED_F1_ORDER = ["KNN", "GaussianNB", "DecisionTree", "RandomForest", "AdaBoost", "XGBoost"]
CORRECTED_F1 = [
    ("KNN", "GaussianNB", 88.45906470481552, 1.532107773982716e-14),
    ("KNN", "DecisionTree", 5.408755801306986, 0.0004280783215178108),
    ("KNN", "RandomForest", -0.793145736470168, 0.44809674172390723),
    ("KNN", "AdaBoost", 14.888752171410363, 1.2034271978933475e-07),
    ("KNN", "XGBoost", -20.541037645253027, 7.174070670856736e-09),
    ("GaussianNB", "DecisionTree", -73.51759491850291, 8.060219158778636e-14),
    ("GaussianNB", "RandomForest", -50.64670565515999, 2.2892798767770728e-12),
    ("GaussianNB", "AdaBoost", -21.06743851255467, 5.737121000493062e-09),
    ("GaussianNB", "XGBoost", -88.53817013201822, 1.509903313490213e-14),
    ("DecisionTree", "RandomForest", -4.925128244253811, 0.0008188083476283747),
    ("DecisionTree", "AdaBoost", 14.988596491061642, 1.1355780715760488e-07),
    ("DecisionTree", "XGBoost", -24.70263780317627, 1.400122462413833e-09),
    ("RandomForest", "AdaBoost", 21.339328767526727, 5.122327895179524e-09),
    ("RandomForest", "XGBoost", -15.304634156055887, 9.472397977106084e-08),
    ("AdaBoost", "XGBoost", -30.966798155945064, 1.8715717864381531e-10),
]

# (model, [[tn, fp], [fn, tp]], accuracy, specificity, precision, recall, f1,
#  precision_weighted, recall_weighted, f1_weighted, balanced_accuracy)
HOLDOUT = [
    ("KNN", [[139780, 2689], [2286, 2880]], 0.9663020286517425, 0.9811257185773747, 0.5171485006284791,
     0.5574912891986062, 0.5365626455519329, 0.9675761468207159, 0.9663020286517425, 0.9669106882942793,
     0.7693085038879905),
    ("NaiveBayes", [[116229, 26240], [2443, 2723]], 0.8057168015714431, 0.8158195818037608, 0.09401650381521251,
     0.5271002710027101, 0.15957103929209762, 0.9484322861483021, 0.8057168015714431, 0.8645981365780548,
     0.6714599264032355),
    ("DecisionTree", [[139217, 3252], [2647, 2519]], 0.9600433501540963, 0.9771739817083015, 0.4364928088719459,
     0.4876113046844754, 0.46063820060345617, 0.9622761088347741, 0.9600433501540963, 0.9611059778317774,
     0.7323926431963884),
    ("RandomForest", [[141539, 930], [2793, 2373]], 0.9747824025468216, 0.9934722641416729, 0.7184377838328792,
     0.45934959349593496, 0.5603967410556145, 0.9714735727331693, 0.9747824025468216, 0.972090638963856,
     0.7264109288188039),
    ("AdaBoost", [[141751, 718], [3898, 1268]], 0.968733701358079, 0.9949603071545389, 0.6384692849949648,
     0.2454510259388308, 0.354586129753915, 0.9615229354480166, 0.968733701358079, 0.961955265863937,
     0.6202056665466849),
    ("XGBoost", [[140885, 1584], [2316, 2850]], 0.9735834998475971, 0.9888817918283977, 0.6427604871447903,
     0.5516840882694541, 0.59375, 0.9718924331281018, 0.9735834998475971, 0.9726102155619233,
     0.770282940048926),
]

# ROC AUC of the ten folds, by model in the order of FOLD_MODELS.
CV_ROC_AUC = [
    [0.7709619531295403, 0.7322942087034358, 0.9154645422428114, 0.8107291555815184, 0.9062762656692108, 0.8399678559002424],
    [0.7698559213748829, 0.7302915761929883, 0.9197752479110863, 0.8034452754060277, 0.9035029596874194, 0.8382727697436397],
    [0.7656945397295488, 0.7328155484157766, 0.9070063571202691, 0.8072196749966603, 0.9017079317207698, 0.8299858562942133],
    [0.7547489265802798, 0.7343174680804335, 0.906113522484643, 0.7973452626510316, 0.886139070213612, 0.823601927891252],
    [0.7602530772371622, 0.7364897948709821, 0.9127028893462574, 0.8122657326084873, 0.901128968105717, 0.8344658562338345],
    [0.7788093564418193, 0.7462775434101259, 0.9189795112993787, 0.8181491974518431, 0.9091665053137558, 0.8445004349995934],
    [0.7658457281293851, 0.7468578625781916, 0.9153273544319955, 0.8117174431023114, 0.9050974363896076, 0.8349174314900375],
    [0.7663516882634875, 0.728684238266766, 0.9104218785393892, 0.7990294174941657, 0.8962219916382261, 0.8405837696205781],
    [0.7696119145017888, 0.7336070161667699, 0.9125182347879904, 0.804801651395535, 0.8982399731308588, 0.8395507494679003],
    [0.7692076094011804, 0.7266335305749695, 0.910629553036364, 0.8028765981855783, 0.8944586094464655, 0.8441121107370899],
]

# Corrected paired t-tests of the ROC AUC (model, model, t, p).
CORRECTED_ROC_AUC = [
    ("KNN", "GaussianNB", 13.931695752241081, 2.139336483519827e-07),
    ("KNN", "DecisionTree", 31.984154324595604, 1.4024692518432857e-10),
    ("KNN", "RandomForest", -56.82192212123798, 8.15347789284715e-13),
    ("KNN", "AdaBoost", -8.89781565751139, 9.373139335355773e-06),
    ("KNN", "XGBoost", -43.57899448711028, 8.810063789610467e-12),
    ("GaussianNB", "DecisionTree", 8.385880327049186, 1.5163108944671322e-05),
    ("GaussianNB", "RandomForest", -59.32457676845821, 5.535572000781031e-13),
    ("GaussianNB", "AdaBoost", -42.288008333951744, 1.1534551092040601e-11),
    ("GaussianNB", "XGBoost", -69.0901415488454, 1.4077627952246985e-13),
    ("DecisionTree", "RandomForest", -53.95790181374999, 1.2967404927621828e-12),
    ("DecisionTree", "AdaBoost", -23.14634516177333, 2.4941797516220277e-09),
    ("DecisionTree", "XGBoost", -59.29989950334017, 5.557776461273534e-13),
    ("RandomForest", "AdaBoost", 20.829382331395113, 6.343082059601102e-09),
    ("RandomForest", "XGBoost", -6.449834810238273, 0.00011816444158041506),
    ("AdaBoost", "XGBoost", -32.14144368630133, 1.342363997736129e-10),
]

# Plain paired t-tests of F1 (model, model, t, p).
PLAIN_F1 = [
    ("DecisionTree", "GaussianNB", 106.81858894063782, 2.8031637942549726e-15),
    ("DecisionTree", "KNN", -7.858739982728837, 2.551331082445249e-05),
    ("DecisionTree", "RandomForest", -7.156045433560091, 5.331235541388461e-05),
    ("DecisionTree", "AdaBoost", 21.77792580334868, 4.278774913637619e-09),
    ("DecisionTree", "XGBoost", -35.89210060764431, 5.006235706719212e-11),
    ("GaussianNB", "KNN", -128.52804122947214, 5.307892827516026e-16),
    ("GaussianNB", "RandomForest", -73.58795725803078, 7.992078245907591e-14),
    ("GaussianNB", "AdaBoost", -30.61027849182755, 2.0752975634319653e-10),
    ("GaussianNB", "XGBoost", -128.6429787504929, 5.265384426114501e-16),
    ("KNN", "RandomForest", -1.1524140375912015, 0.27884097497675003),
    ("KNN", "AdaBoost", 21.63285537019985, 4.539396703999124e-09),
    ("KNN", "XGBoost", -29.84543576370754, 2.6008017446846666e-10),
    ("RandomForest", "AdaBoost", 31.005325873546454, 1.8509184893783906e-10),
    ("RandomForest", "XGBoost", -22.237117884702837, 3.5572533055042402e-09),
    ("AdaBoost", "XGBoost", -44.99371458892873, 6.616418698356877e-12),
]

# Plain paired t-tests of the ROC AUC (model, model, t, p).
PLAIN_ROC_AUC = [
    ("DecisionTree", "GaussianNB", -12.184401632744404, 6.7611800444439e-07),
    ("DecisionTree", "KNN", -46.47189883184054, 4.951858761956717e-12),
    ("DecisionTree", "RandomForest", -78.39901373720875, 4.52351259943696e-14),
    ("DecisionTree", "AdaBoost", -33.63085982416052, 8.956675209240411e-11),
    ("DecisionTree", "XGBoost", -86.16075643239252, 1.9361218186513682e-14),
    ("GaussianNB", "KNN", -20.242284632057913, 8.16446959815439e-09),
    ("GaussianNB", "RandomForest", -86.19661166734336, 1.9288934913881877e-14),
    ("GaussianNB", "AdaBoost", -61.44305161710048, 4.0400369970037373e-13),
    ("GaussianNB", "XGBoost", -100.38564833544592, 4.900497188563006e-15),
    ("KNN", "RandomForest", -82.56033876807155, 2.8417331359062863e-14),
    ("KNN", "AdaBoost", -12.928226423115355, 4.071967392824148e-07),
    ("KNN", "XGBoost", -63.318811010143286, 3.083842854926749e-13),
    ("RandomForest", "AdaBoost", 30.264390879640974, 2.2967297041471547e-10),
    ("RandomForest", "XGBoost", -9.371392713453154, 6.126056131802609e-06),
    ("AdaBoost", "XGBoost", -46.7004349760303, 4.738770473540817e-12),
]
